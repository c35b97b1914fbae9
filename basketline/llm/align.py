"""Cross-tokenizer alignment: the token ends of two tokenizers, merged along a merge path.

The ends of both tokenizations of a batch are two sorted arrays. Their merge path is cut at every
WORK-th diagonal by binary searches, so that each piece is the same number of merge steps whatever the
documents' lengths. All pieces take their steps side by side and emit the overlaps of tokens; the
groups that cross a piece's border are stitched by the numbers of cuts in the pieces before.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketline.llm import textcodes as X
from basketline.llm.bpe import REMEMBERED, Codec
from basketline.llm.common import document_rows, scratch, stored

WORK = 64  # merge steps of a piece
BATCH = 2 << 20  # bytes of text that are aligned at once; one longer text stands alone
IDS = 1 << 16  # ids of either tokenizer are below this


class PlainCodec(Codec):
    """A byte-level codec for which the strings of special tokens are ordinary text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.special = {}
        self.split_special = re.compile(r"(?!)")


class Pieces(Codec):
    """A sentencepiece model over a whole batch; segments that it never joins are encoded once and remembered.

    A segment is a run of spaces with what stands before the next run. No piece has a space mark
    behind another character, so no merge crosses the border of two segments. Segments are known by a
    hash of their bytes, as pre-tokens are.
    """

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.whole = any(re.search("[^▁]▁", n) for n in names)  # then a document is one segment
        byte = re.compile("<0x([0-9A-F]{2})>")
        self.bytes = [bytes([int(m[1], 16)]) if (m := byte.fullmatch(n)) else n.replace("▁", " ").encode() for n in names]
        self.codes = X.random_codes(256)
        self.forget()

    def _pieces(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of segments without their first space; the model puts one before every text but an empty one."""
        found = self.model.encode([s.decode() for s in segments], num_threads=1)
        found = [ids if s else [self.model.piece_to_id("▁")] for s, ids in zip(segments, found)]
        count = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.uint32, int(count.sum())), count

    def __call__(self, raw: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all documents of raw, each with a space in front, and how many each has."""
        if self.n > REMEMBERED:
            self.forget()
        data = np.frombuffer(raw, np.uint8)
        first = np.zeros(len(data), bool)
        if not self.whole:
            space = data == 0x20
            first[1:] = space[1:] & ~space[:-1]
        first[offsets[:-1][np.diff(offsets) > 0]] = True
        begin = np.flatnonzero(first)
        to = np.append(begin[1:], len(data))
        slots = np.empty(len(begin), np.int64)
        lo = 0
        while lo < len(begin):  # spans of about so many bytes at once
            hi = max(lo + 1, int(np.searchsorted(to, begin[lo] + X.CHUNK, "right")))
            at, end = begin[lo:hi], to[lo:hi]
            (hashes,) = X.span_hashes(self.codes[data[at[0] : end[-1]]], at - at[0], end - at[0])
            found = self._find(hashes)
            new = np.flatnonzero(found < 0)
            if len(new):
                distinct, one = np.unique(hashes[new], return_index=True)
                spans = zip(at[new[one]].tolist(), end[new[one]].tolist())
                self._put(distinct, self._remember(*self._pieces([raw[x + 1 : y] for x, y in spans])))
                found[new] = self._find(hashes[new])
            slots[lo:hi] = found
            lo = hi
        total = np.concatenate([[0], np.cumsum(self.count[slots])])
        return self.expand(slots), np.diff(total[np.searchsorted(begin, offsets)])


def _joined(names: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all names, and the offsets of each."""
    return np.frombuffer(b"".join(names), np.uint8), np.concatenate([[0], np.cumsum(list(map(len, names)))])


class Pair:
    """Both tokenizers of a worker process, with the bytes of every id; see ``pair``."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = PlainCodec(path_a), Pieces(path_b)
        named = {i: bytes(self.a.to_byte[c] for c in t.decode()) for i, t in self.a.names.items()}
        self.bytes_a = _joined([named.get(i, b"") for i in range(max(named) + 1)])
        self.bytes_b = _joined(self.b.bytes)
        self.length_a, self.length_b = np.diff(self.bytes_a[1]), np.diff(self.bytes_b[1])

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids and their numbers by both tokenizers; a text has none where either does not give back space + text."""
        spaced = [" " + t if t else "" for t in texts]
        coded = [t.encode() for t in spaced]
        raw, offsets = b"".join(coded), np.concatenate([[0], np.cumsum(list(map(len, coded)))])
        slots = self.a.slots(spaced)
        n_a = np.fromiter((int(self.a.count[s].sum()) for s in slots), np.int64, len(slots))
        a = self.a.expand(np.concatenate(slots)).astype(np.int32) if slots else np.zeros(0, np.int32)
        b, n_b = self.b(raw, offsets)
        b = b.astype(np.int32)
        same = self._same(a, n_a, *self.bytes_a, raw, offsets) & self._same(b, n_b, *self.bytes_b, raw, offsets)
        if not same.all():
            a, n_a = a[np.repeat(same, n_a)], np.where(same, n_a, 0)
            b, n_b = b[np.repeat(same, n_b)], np.where(same, n_b, 0)
        return a, n_a, b, n_b

    def _same(self, ids: np.ndarray, n: np.ndarray, names: np.ndarray, at: np.ndarray, raw: bytes, offsets: np.ndarray) -> np.ndarray:
        """Whether the bytes of each document's ids are those of the document."""
        size = (at[1:] - at[:-1])[ids]
        ends = np.cumsum(size)
        total = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(n)])]
        same = np.diff(total) == np.diff(offsets)
        given = names[np.repeat(at[ids] - ends + size, size) + np.arange(int(total[-1]))]
        data = np.frombuffer(raw, np.uint8)
        if same.all():
            wrong = np.flatnonzero(given != data)
            same[np.searchsorted(offsets, wrong, "right") - 1] = False
        else:
            for i in np.flatnonzero(same).tolist():
                same[i] = np.array_equal(given[total[i] : total[i + 1]], data[offsets[i] : offsets[i + 1]])
        return same


@lru_cache(maxsize=2)
def pair(path_a: str, path_b: str) -> Pair:
    """The tokenizers of two files, once per worker process."""
    return Pair(path_a, path_b)


def diagonals(a: np.ndarray, b: np.ndarray, work: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the merge path of two sorted arrays crosses every ``work``-th diagonal, and its end.

    Returns how many of each array lie before the crossing; of equal values that of ``a`` comes first.
    """
    total = len(a) + len(b)
    d = np.append(np.arange(0, total, work), total)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open := np.flatnonzero(low < high)).size:
        mid = (low[open] + high[open]) // 2
        before = a[mid] <= b[d[open] - mid - 1]
        low[open[before]] = mid[before] + 1
        high[open[~before]] = mid[~before]
    return low, d - low


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, ...]:
    """Every pair of tokens whose byte ranges overlap, in order: position in a, in b, group, and whether they end together.

    Both arrays rise strictly and have the same last end. A group ends where ends of both meet.
    """
    if not len(ends_a):
        return (*[np.zeros(0, np.int64)] * 3, np.zeros(0, bool))
    cut_a, cut_b = diagonals(ends_a, ends_b, work)
    i, j = cut_a[:-1].astype(np.int32), cut_b[:-1].astype(np.int32)
    steps = np.diff(cut_a) + np.diff(cut_b)
    far = np.iinfo(np.int64).max
    to_a, to_b = np.append(ends_a, far), np.append(ends_b, far)
    x, y = to_a[i], to_b[j]
    begin = np.maximum(np.where(i > 0, to_a[i - 1], 0), np.where(j > 0, to_b[j - 1], 0))
    at_a, at_b = np.empty((work, len(i)), np.int32), np.empty((work, len(i)), np.int32)
    some, cuts = np.zeros((work, len(i)), bool), np.zeros((work, len(i)), bool)
    for s in range(work):
        at_a[s], at_b[s] = i, j
        end = np.minimum(x, y)
        some[s] = (begin < end) & (s < steps)
        cuts[s] = some[s] & (x == y)
        first = x <= y
        i += first
        j += ~first
        np.minimum(i, len(ends_a), out=i)
        np.minimum(j, len(ends_b), out=j)
        x, y, begin = to_a[i], to_b[j], end
    inside = np.cumsum(cuts, 0, dtype=np.int32)
    before = np.cumsum(inside[-1], dtype=np.int64) - inside[-1]  # cuts in earlier pieces: groups go on across borders
    group = before + inside - cuts
    some = some.T
    return at_a.T[some], at_b.T[some], group.T[some], cuts.T[some]


class Alignment:
    """The aligned tokens of a batch of documents."""

    def __init__(self, both: Pair, texts: list[str]):
        self.a, self.n_a, self.b, self.n_b = both(texts)
        self.end_a, self.end_b = np.cumsum(both.length_a[self.a]), np.cumsum(both.length_b[self.b])
        in_a, in_b, group, cut = overlaps(self.end_a, self.end_b)
        self.group_a, self.group_b = np.empty(len(self.a), np.int64), np.empty(len(self.b), np.int64)
        self.group_a[in_a], self.group_b[in_b] = group, group
        self.link_a, self.link_b = in_a[cut], in_b[cut]
        self.first_a = np.concatenate([[0], np.cumsum(self.n_a)])  # tokens before each document
        self.first_b = np.concatenate([[0], np.cumsum(self.n_b)])
        self.first = np.searchsorted(self.link_a, self.first_a)  # links, and so groups, before each document

    def codes(self) -> np.ndarray:
        """A code of the two ids of every link."""
        return self.a[self.link_a].astype(np.int64) * IDS + self.b[self.link_b]

    def shown(self) -> Iterator[bytes]:
        """The groups of each document as text: a1,a2|b1;a3|b2,b3."""
        n_a, n_b = len(self.a), len(self.b)
        ids, mark = np.empty(n_a + n_b, np.int64), np.full(n_a + n_b, ord(","), np.uint8)
        to_a = np.searchsorted(self.group_a, np.arange(len(self.link_a)), "right")  # tokens up to each group's end
        to_b = np.searchsorted(self.group_b, np.arange(len(self.link_a)), "right")
        at_a = np.arange(n_a) + np.concatenate([[0], to_b])[self.group_a]
        at_b = np.arange(n_b) + to_a[self.group_b]
        ids[at_a], ids[at_b] = self.a, self.b
        mark[at_a[to_a - 1]], mark[at_b[to_b - 1]] = ord("|"), ord(";")
        digits, keep = _digits()
        body = digits[ids]
        body[:, -1] = mark
        keep = keep[ids]
        size = np.concatenate([[0], np.cumsum(keep.sum(1))])[self.first_a + self.first_b]
        flat = body[keep].tobytes()
        for lo, hi in zip(size[:-1].tolist(), size[1:].tolist()):
            yield flat[lo : hi - 1] if hi > lo else b""


@lru_cache(maxsize=1)
def _digits() -> tuple[np.ndarray, np.ndarray]:
    """The decimal digits of every id with a place for the mark behind, and which of them are written."""
    n = np.arange(IDS)
    body = np.zeros((IDS, 6), np.uint8)
    for k in range(5):
        body[:, 4 - k] = ord("0") + n // 10**k % 10
    return body, np.concatenate([n[:, None] >= 10 ** np.arange(4, 0, -1), np.ones((IDS, 2), bool)], 1)


def _lists(flat: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat, kind))


def alignments(documents: DataFrame, tokenizer_a: str, tokenizer_b: str) -> DataFrame:
    """One row per document: doc_id, a_ids, b_ids, and per group a_cuts, b_cuts, ends.

    Group g has a_ids[a_cuts[g - 1] : a_cuts[g]], the same of b, and ends before byte ends[g] of
    space + text. Documents without tokens (null, empty, or not given back by a tokenizer) have empty arrays.
    """

    def run(batches):
        both = pair(tokenizer_a, tokenizer_b)
        for big in batches:
            for batch in X.slices(big, "text", BATCH):
                x = Alignment(both, batch.column("text").to_pylist())
                n = np.diff(x.first)
                of = lambda c: np.repeat(c[:-1], n)
                base = np.concatenate([[0], x.end_a])[x.first_a]
                cuts = [x.link_a + 1 - of(x.first_a), x.link_b + 1 - of(x.first_b), x.end_a[x.link_a] - of(base)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), _lists(x.a, x.first_a, pa.int32()), _lists(x.b, x.first_b, pa.int32()),
                        *[_lists(c, x.first, pa.int64()) for c in cuts],
                    ],
                    names=["doc_id", "a_ids", "b_ids", "a_cuts", "b_cuts", "ends"],
                )

    kind = "doc_id long, a_ids array<int>, b_ids array<int>, a_cuts array<long>, b_cuts array<long>, ends array<long>"
    return document_rows(documents).mapInArrow(run, kind)


def _profiles(documents: DataFrame, tokenizer_a: str, tokenizer_b: str) -> DataFrame:
    """The digest columns of each document, its distinct id pairs and how often it links each."""

    def run(batches):
        both = pair(tokenizer_a, tokenizer_b)
        for big in batches:
            for batch in X.slices(big, "text", BATCH):
                x = Alignment(both, batch.column("text").to_pylist())
                rows = np.repeat(np.arange(batch.num_rows), np.diff(x.first))
                distinct, times = np.unique((rows << 32) + x.codes(), return_counts=True)
                offsets = np.searchsorted(distinct, np.arange(batch.num_rows + 1) << 32)
                sha = [hashlib.sha256(s).hexdigest() if s else "" for s in x.shown()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), pa.array(x.n_a), pa.array(x.n_b), pa.array(np.diff(x.first)), pa.array(sha, pa.string()),
                        _lists((distinct & 0xFFFFFFFF).astype(np.uint32).view(np.int32), offsets, pa.int32()),
                        _lists(times.astype(np.int32), offsets, pa.int32()),
                    ],
                    names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "codes", "times"],
                )

    kind = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, codes array<int>, times array<int>"
    return document_rows(documents).mapInArrow(run, kind)


def _flat(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def link_counts(profiles: DataFrame) -> DataFrame:
    """a_id, b_id and how many links of the whole table hold them linked; summed in each task first.

    Tokens that end together are suffixes of each other, so there are at most as many id pairs as
    the tokens of both vocabularies have suffixes, a few bytes each: a fixed number for any table.
    """

    def run(batches):
        codes, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            code = np.concatenate([codes, _flat(batch.column("codes")).view(np.uint32).astype(np.int64)])
            times = np.concatenate([n, _flat(batch.column("times"))])
            codes, at = np.unique(code, return_inverse=True)
            n = np.zeros(len(codes), np.int64)
            np.add.at(n, at, times)
        yield pa.RecordBatch.from_arrays([pa.array(codes // IDS), pa.array(codes % IDS), pa.array(n)], names=["a_id", "b_id", "n"])

    found = profiles.select("codes", "times").mapInArrow(run, "a_id long, b_id long, n long")
    return found.groupBy("a_id", "b_id").agg(F.sum("n").alias("n"))


def alignment_digests(documents: DataFrame, tokenizer_a: str, tokenizer_b: str) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Links are pairs of an A and a B token that end at the same byte of space + text; the count of an
    id pair is the number of links of the whole table that hold it. ``n_best`` counts the links whose
    pair has the highest count of its B id, ties included. Null and empty texts, and those that
    either tokenizer does not give back byte for byte, have zeros and ''. Every row counts: repeated
    rows have results of their own, a null doc_id stays null; other columns are not looked at.
    The counts, bounded by both vocabularies (``link_counts``), are the only thing that is broadcast.
    """
    spark = documents.sparkSession
    with scratch(spark) as keep:
        rows = stored(_profiles(documents, tokenizer_a, tokenizer_b))
        table = link_counts(rows).toPandas().sort_values(["a_id", "b_id"])
        best = table.groupby("b_id")["n"].transform("max") == table["n"]
        shared = spark.sparkContext.broadcast(
            (np.append(table["a_id"].to_numpy(np.int64) * IDS + table["b_id"].to_numpy(np.int64), -1), np.append(table["n"].to_numpy(np.int64), 0), np.append(best.to_numpy(bool), False))
        )

        def run(batches):
            codes, counts, is_best = shared.value
            for batch in batches:
                ends = batch.column("codes")
                offsets = ends.offsets.to_numpy() - ends.offsets[0].as_py()
                at = np.searchsorted(codes[:-1], _flat(ends).view(np.uint32).astype(np.int64))
                times = _flat(batch.column("times")).astype(np.int64)
                sums = [np.concatenate([[0], np.cumsum(v)]) for v in (times * is_best[at], times * counts[at])]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")], batch.column("n_groups"), *[pa.array(s[offsets[1:]] - s[offsets[:-1]]) for s in sums], batch.column("groups_sha256")],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
                )

        kind = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
        return keep(rows.mapInArrow(run, kind))
