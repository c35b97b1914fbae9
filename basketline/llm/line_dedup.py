"""Fuzzy line dedup: MinHash of character shingles, banding, exact Jaccard, distributed union-find."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketline.llm import textcodes as X
from basketline.llm.common import (
    KEY_ROWS, bitmap, document_rows, fresh, identified, intersection, key_rows, led_by_heads, linked, most_in_common, overlaps, scratch, screened, stored, with_facts,
)

SHINGLE = 8  # bytes
BANDS, ROWS = 10, 4  # a similarity of 0.8 is a candidate with a chance of 0.995, 0.9 with 1 - 3e-5
NUM, DEN = 80, 100


def _shingle_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all shingles of every line, and the offsets of the lines.

    A shingle is the SHINGLE bytes of UTF-8 from any character on, read as one 64-bit number and
    mixed, so equal codes are equal shingles. A shorter line is one shingle.
    """
    raw, offsets = X.buffers(texts)
    padded = np.concatenate([raw, np.zeros(SHINGLE, np.uint8)])
    window = np.ndarray(len(raw) + 1, "<u8", padded, strides=(1,))
    begins = (raw & 0xC0) != 0x80
    short = np.flatnonzero((np.diff(offsets) < SHINGLE) & (np.diff(offsets) > 0))
    # The last SHINGLE - 1 bytes of a line begin no shingle.
    for back in range(1, SHINGLE):
        at = offsets[1:] - back
        begins[at[at >= offsets[:-1]]] = False
    begins[offsets[short]] = True
    at = np.flatnonzero(begins)
    codes = window[at]
    where = np.searchsorted(at, offsets[short])
    codes[where] &= (X.U(1) << (8 * np.diff(offsets)[short]).astype(X.U)) - X.U(1)
    return X.mix(codes), np.searchsorted(at, offsets)


def min_hashes(codes: np.ndarray, to: np.ndarray, n: int) -> np.ndarray:
    """n min-hashes of each run of codes; every run has one code at least."""
    out = np.empty((n, len(to) - 1), np.uint32)
    factors = np.random.default_rng(3).integers(0, 1 << 31, size=n, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    high, low = (codes >> X.U(32)).astype(np.uint32), codes.astype(np.uint32)
    starts = to[:-1]
    lots = [0]  # lines of about so many codes at once stay in the caches
    while lots[-1] < len(starts):
        lots.append(max(lots[-1] + 1, int(np.searchsorted(starts, starts[lots[-1]] + (1 << 14)))))
    for a, b in zip(lots, lots[1:]):
        x, y, at = high[to[a] : to[b]], low[to[a] : to[b]], starts[a:b] - to[a]
        z = np.empty_like(x)
        for k in range(n):
            np.multiply(x, factors[k], out=z)
            np.add(z, y, out=z)
            np.minimum.reduceat(z, at, out=out[k, a:b])
    return out


def lines_of(documents: DataFrame) -> DataFrame:
    """doc_id, position, text and two hashes of every line that is not blank; a null doc_id has none."""
    rows = documents.where("doc_id is not null").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))
    rows = rows.select("doc_id", "line_no", F.trim("line").alias("line")).where("line <> ''")
    return rows.select("*", F.xxhash64("line").alias("id"), F.xxhash64(F.lit(1), "line").alias("id2"))


def band_keys(lines: DataFrame) -> DataFrame:
    """``key_rows`` of the lines' bands; a line that repeats in a batch is hashed once."""

    def run(batches):
        for big in batches:
            for batch in X.slices(big, "line"):
                _, first = np.unique(batch.column("id").to_numpy(), return_index=True)
                batch = batch.take(pa.array(first))
                hashes, to = _shingle_codes(batch.column("line"))
                mins = min_hashes(hashes, to, BANDS * ROWS).reshape(BANDS, ROWS, -1)
                keys = np.empty((batch.num_rows, BANDS), X.U)
                for b in range(BANDS):
                    total = np.full(batch.num_rows, X.U(b + 1))
                    for r in range(ROWS):
                        total = X.mix(total * X.U(X.ODD) + mins[b, r].astype(X.U))
                    keys[:, b] = total
                yield key_rows(batch.column("id").to_numpy(), keys.ravel(), np.arange(0, keys.size + 1, BANDS))

    return lines.select("id", "line").mapInArrow(run, KEY_ROWS)


def similar(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """The pairs (a, b) of lines whose shingle sets have a Jaccard similarity of NUM / DEN or more."""

    def run(batches):
        for big in batches:
            for batch in X.slices(big, "line_b"):
                n_a, n_b, both = overlaps(*_shingle_codes(batch.column("line_a")), *_shingle_codes(batch.column("line_b")))
                keep = pa.array(both * (NUM + DEN) >= (n_a + n_b) * NUM)
                yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], names=["a", "b"])

    # Only the lines of each side are moved.
    a, b = (
        screened(lines, pairs.select(F.col(s).alias("id")), "id").select(F.col("id").alias(s), F.col("line").alias(f"line_{s}")) for s in "ab"
    )
    return pairs.join(b, "b").join(a, "a").select("a", "b", "line_a", "line_b").mapInArrow(run, "a long, b long")


class _Tile:
    """The lines of a bucket, each distinct text once; ``rows`` have sets, and size and bitmap as columns ``n`` and ``bits``."""

    def __init__(self, found: pa.Table, rows: np.ndarray):
        distinct = found.column("line").combine_chunks().dictionary_encode()
        self.codes, self.at = _shingle_codes(distinct.dictionary)
        self.own = distinct.indices.to_numpy()
        self.sets: list[np.ndarray | None] = [None] * found.num_rows
        bits: list[bytes | None] = [None] * found.num_rows
        order = rows[np.argsort(self.own[rows], kind="stable")]
        texts, at = np.unique(self.own[order], return_index=True)
        for text, group in zip(texts.tolist(), np.split(order, at[1:])):
            own = X.distinct(self.codes[self.at[text] : self.at[text + 1]])
            sign = bitmap(own)
            for i in group.tolist():
                self.sets[i], bits[i] = own, sign
        n = pa.array([0 if s is None else len(s) for s in self.sets], pa.int64())
        self.signed = pa.table({"n": n, "bits": pa.array(bits, pa.binary())})

    def holds(self, i: int, j: int) -> bool:
        x, y = self.sets[i], self.sets[j]
        least = -(-(len(x) + len(y)) * NUM // (NUM + DEN))
        return min(len(x), len(y)) >= least and intersection(x, y) >= least

    def all_hold(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """``holds`` of many pairs of rows, of about a million shingles at a time."""
        sides = self.own[i], self.own[j]
        total = np.cumsum(sum(np.diff(self.at)[s] for s in sides))
        lots = np.unique(np.searchsorted(total, np.arange(0, total[-1] if len(total) else 0, 1 << 20)))
        out = [np.zeros(0, bool)]
        for lo, hi in zip(lots, [*lots[1:], len(i)]):
            n_a, n_b, both = overlaps(*[c for s in sides for c in self._codes(s[lo:hi])])
            out.append(both * (NUM + DEN) >= (n_a + n_b) * NUM)
        return np.concatenate(out)

    def _codes(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = np.diff(self.at)[rows]
        at = np.concatenate([[0], np.cumsum(size)])
        return self.codes[np.repeat(self.at[:-1][rows] - at[:-1], size) + np.arange(at[-1])], at


def line_classes(lines: DataFrame) -> DataFrame:
    """id and id2 of each line that occurs or is alike more than once, and its class.

    ``lines`` is a stored table as ``lines_of`` makes it, with texts. Links are verified where lines meet.
    """
    with scratch(lines.sparkSession) as keep:
        counted = stored(lines.groupBy("id", "id2").agg(F.count(F.lit(1)).alias("n")))
        members = stored(led_by_heads(band_keys(lines)))
        ids = members.select("id").distinct()
        texts = stored(screened(lines.select("id", "line"), ids, "id").dropDuplicates(["id"]))
        tiles: dict[int, _Tile] = {}

        def may_link(found: pa.Table, left: np.ndarray, right: np.ndarray) -> np.ndarray:
            signed = tiles[id(found)].signed
            n = signed.column("n").to_numpy()
            return most_in_common(signed, left, right) * (NUM + DEN) >= (n[left][:, None] + n[right][None]) * NUM

        def exact(found: pa.Table, rows: np.ndarray):
            tiles.clear()
            tiles[id(found)] = tile = _Tile(found, rows)
            return tile.holds, tile.all_hold

        found = linked(members, lambda pairs: similar(pairs, texts), lambda: texts, may_link, exact)
        classes = counted.join(found, "id", "left").where("n > 1 or component is not null")
        # Lines that are alike to no other one are a class by both hashes.
        return keep(classes.select("id", "id2", F.coalesce("component", "id").alias("class"), F.col("component").isNull().alias("alone")))


@F.arrow_udf(T.StringType())
def without_lines(text: pa.Array, gone: pa.Array) -> pa.Array:
    """The texts without the lines at some positions; most texts have none to lose and stay as they are."""
    some = pc.fill_null(gone.is_valid(), False)
    at = np.flatnonzero(some.to_numpy(zero_copy_only=False))
    if not len(at):
        return text
    out = []
    for i in at.tolist():
        lines = np.array(text[i].as_py().split("\n"), object)
        keep = np.ones(len(lines), bool)
        keep[gone[i].values.to_numpy(zero_copy_only=False)] = False
        out.append("\n".join(lines[keep].tolist()))
    return pc.replace_with_mask(text, some, pa.array(out, text.type))


def removed_lines(documents: DataFrame) -> DataFrame:
    """doc_id and the positions of the lines that go, in order; stored."""
    with scratch(documents.sparkSession) as keep:
        lines = stored(lines_of(documents))
        places = lines.select("id", "id2", "doc_id", "line_no").join(line_classes(lines), ["id", "id2"])
        places = stored(places.select("class", F.when(F.col("alone"), F.col("id2")).alias("other"), "doc_id", "line_no"))
        firsts = places.groupBy("class", "other").agg(F.min(F.struct("doc_id", "line_no")).alias("keep"))
        same = (F.col("f.class") == F.col("p.class")) & F.col("f.other").eqNullSafe(F.col("p.other"))
        gone = places.alias("p").join(firsts.alias("f"), same).where(F.struct("p.doc_id", "p.line_no") != F.col("f.keep"))
        return keep(gone.groupBy("p.doc_id").agg(F.sort_array(F.collect_set("p.line_no")).alias("gone")))


def deduplicated(documents: DataFrame) -> DataFrame:
    """The documents, all columns, with ``text`` less its repeated lines, n_lines and n_removed.

    Lines are alike when they are equal but for spaces around them, or when the sets of their
    8-byte shingles, one from each character on, have a Jaccard similarity of 0.8 or more; classes
    are their connected components, over all documents, and the first line of each (by doc_id, then
    position) stays. Blank lines stay where they are. A null text is empty and has no line; a document
    whose lines all go is left with an empty text. Each row is a document of its own: of several rows of a doc_id the
    first by a hash of its text has that place, further ones and rows without doc_id come behind all others (``identified``).
    Candidates have one of BANDS bands of ROWS min-hashes in common.
    The added columns get underscores behind their names where the table has those names already.
    """
    names = documents.columns
    rows, key, _ = identified(documents)
    plain = rows.select(F.col(key).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own, gone, n_lines, n_removed = (fresh([*names, key], c) for c in ("of_row", "gone", "n_lines", "n_removed"))
    removed = removed_lines(plain).select(F.col("doc_id").alias(own), F.col("gone").alias(gone))
    out = with_facts(rows.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit(""))), removed, key)
    lines = F.when(F.col("text") == "", 0).otherwise(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1)
    left = without_lines(F.col("text"), F.col(gone))
    return out.select(
        *[left.alias(c) if c == "text" else F.col(f"`{c}`") for c in names],
        lines.cast("long").alias(n_lines),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias(n_removed),
    )


def line_digests(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_lines, n_removed, n_chars and SHA-256 of the text that stays; stored."""
    with scratch(documents.sparkSession) as keep:
        rows = deduplicated(document_rows(documents))
        return keep(rows.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256")))
