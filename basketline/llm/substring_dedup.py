"""Substring dedup: MinHash bands over sliding paragraphs, exact verification, removal by components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketline.llm import textcodes as X
from basketline.llm.common import components, document_rows, fresh, groups_of, identified, overlaps, scratch, screened, stored, tiled, with_facts
from basketline.llm.line_dedup import min_hashes

SHINGLE = 5  # words
LEAST = 50  # words of a repeated passage
NUM, DEN = 80, 100
# Places are minima over so many shingles. An edit costs a passage SHINGLE shingles, so similar passages of LEAST
# words allow one, and their longer half keeps 21 equal shingles in a row; longer passages keep more. The first and
# the last window of those do not overlap, so two minima at least lie inside: a place that both passages have.
WINDOW = ((LEAST - SHINGLE + 1 - SHINGLE + 1) // 2) // 2
BANDS, ROWS = 6, 2  # of the paragraphs beside a place: a similarity of 0.5 is a candidate with a chance of 0.82, 0.8 with 0.998
AROUND = 128  # words to each side of a place within which a similar passage is looked for
NEXT = 12  # words from a place on that are a key by themselves, whatever follows
APART = 32  # words of a block of which one place is held against the other side
COSTS = (8, 4, 2)  # of a shingle that the other side lacks, against 1 for one that it has; 8 holds 0.8 all along
# A stretch of highest sum has at least so many shingles that the other side has: all but the place's own add up to 0 or more.
FEWEST = -(-COSTS[-1] * (LEAST - SHINGLE) // (COSTS[-1] + 1))
FEW = 64  # places of a key of which all pairs are rows; those of larger keys have to share a rare shingle too
QUICK = 1 << 12  # buckets of the hashed shingles of a stretch, by which most pairs are turned away
BINS = 1 << 20  # hashed shingles whose numbers tell which of a place are rare


def _row_shingles(codes: np.ndarray) -> np.ndarray:
    return X.shingles(codes, np.array([0, len(codes)]), SHINGLE)[0]


def minima(codes: np.ndarray) -> np.ndarray:
    """Positions of the min-hash of every window of shingles, each once."""
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    w = min(WINDOW, n)
    # Minimum of a sliding window from prefix and suffix minima of blocks of its length.
    blocks = -(-n // w)
    padded = np.full(blocks * w, np.iinfo(np.uint64).max, X.U)
    padded[:n] = codes
    padded = padded.reshape(blocks, w)
    prefix = np.minimum.accumulate(padded, 1).ravel()
    suffix = np.minimum.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    low = np.minimum(suffix[: n - w + 1], prefix[w - 1 : n])
    # Windows in a row with one minimum: mostly they share its only position.
    begin = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    last = np.concatenate([begin[1:] - 1, [len(low) - 1]])
    order = np.argsort(codes, kind="stable")
    found = order[np.searchsorted(codes[order], low[begin], "right") - 1]
    odd = (found < last) | (found >= begin + w)
    out = [found[~odd]]
    # Repeated codes: the rightmost place in a window, until it leaves the window.
    for s, e in zip(begin[odd].tolist(), last[odd].tolist()):
        places = s + np.flatnonzero(codes[s : e + w] == low[s])
        while s <= e:
            place = int(places[np.searchsorted(places, s + w) - 1])
            out.append(np.array([place]))
            s = place + 1
    return X.distinct(np.concatenate(out))


def headed(keys: np.ndarray, docs: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    """(key, doc_id, pos, head_doc, head_pos): places by key, whose first one in the batch is the head of other documents' places.

    Heads, and further places of the head's own document, have no head. So a key that very many documents
    have is a few rows without head for each batch.
    """
    order = np.lexsort((pos, docs, keys))
    keys, docs, pos = keys[order], docs[order], pos[order]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    head = np.flatnonzero(first)[np.cumsum(first) - 1]
    own = docs[head] == docs
    followed = first & (~np.append(first[1:], True))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(keys.view(np.int64)), pa.array(docs), pa.array(pos, pa.int64()),
            pa.array(docs[head], mask=own), pa.array(pos[head], pa.int64(), mask=own), pa.array(followed),
        ],
        names=["key", "doc_id", "pos", "head_doc", "head_pos", "followed"],
    )


HEADED = "key long, doc_id long, pos long, head_doc long, head_pos long, followed boolean"


def first_places(rows: DataFrame) -> DataFrame:
    """Every place of ``headed`` with an earlier one of its key, (other, other_pos), by doc_id and position: the first, or its head."""
    over = Window.partitionBy("key", "head_doc").orderBy("doc_id", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    led = rows.withColumns({"_doc": F.first("doc_id").over(over), "_pos": F.first("pos").over(over)})
    other, at = F.coalesce("head_doc", "_doc"), F.coalesce("head_pos", "_pos")
    led = led.select("key", "doc_id", "pos", other.alias("other"), at.alias("other_pos"))
    return led.where((F.col("other") < F.col("doc_id")) | (F.col("other_pos") < F.col("pos")))


def shared_places(rows: DataFrame) -> DataFrame:
    """(doc_id, pos) of the places whose key some other place has too.

    A head whose only followers are in its own batch is told by their number.
    """
    over = Window.partitionBy("key", "head_doc")
    some = rows.withColumn("_n", F.count(F.lit(1)).over(over))
    return some.where("_n > 1 or head_doc is not null or followed").select("doc_id", "pos")


def bands(documents: DataFrame) -> DataFrame:
    """``headed`` places: pairs of consecutive window minima; pos is the first one's word."""

    def run(batches):
        for big in batches:
            for batch in X.slices(big, "text"):
                codes, offsets = X.words(batch.column("text"))
                shingles, begin = X.shingles(codes, offsets, SHINGLE)
                order = X.mix(shingles ^ X.U(0xA5A5A5A5))
                rows, keys, where = [], [], []
                for i, (a, b) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist())):
                    if b - a < LEAST - SHINGLE + 1:
                        continue
                    own = shingles[a:b]
                    at = minima(order[a:b])
                    gap = np.diff(at)
                    key = X.mix(own[at[:-1]] * X.U(3) ^ X.mix(own[at[1:]]) + gap.astype(X.U))
                    keys.append(key[gap <= 2 * WINDOW])
                    where.append(at[:-1][gap <= 2 * WINDOW])
                    rows.append(np.full(len(keys[-1]), i))
                if keys:
                    doc_ids = batch.column("doc_id").to_numpy()
                    yield headed(np.concatenate(keys), doc_ids[np.concatenate(rows)], np.concatenate(where))

    return documents.mapInArrow(run, HEADED)


def worked(documents: DataFrame, places: DataFrame) -> DataFrame:
    """doc_id, its shared places, its words as 32-bit codes, and the words that begin a line; documents with places alone."""

    def run(batches):
        for big in batches:
            for batch in X.slices(big, "text"):
                codes, offsets = X.words(batch.column("text"))
                short = (codes >> X.U(32)).astype("<u4")
                words = [short[a:b].tobytes() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                begins = []
                for text in batch.column("text").to_pylist():
                    raw = text.encode()
                    starts = X.word_spans(raw)[:, 0]
                    lines = np.searchsorted(starts, np.flatnonzero(np.frombuffer(raw, np.uint8) == 10))
                    begins.append(X.distinct(np.concatenate([[0], lines])).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), batch.column("places"), pa.array(words, pa.binary()), pa.array(begins, pa.list_(pa.int32()))],
                    names=["doc_id", "places", "words", "lines"],
                )

    lists = stored(places.groupBy("doc_id").agg(F.sort_array(F.collect_set("pos")).alias("places")))
    texts = screened(documents, lists.select("doc_id"), "doc_id").join(lists, "doc_id").select("doc_id", "text", "places")
    return texts.mapInArrow(run, "doc_id long, places array<long>, words binary, lines array<int>")


def _column(batch: pa.RecordBatch, name: str, i: int) -> np.ndarray:
    return batch.column(name)[i].values.to_numpy(zero_copy_only=False)


def _codes(batch: pa.RecordBatch, name: str, i: int) -> np.ndarray:
    return np.frombuffer(batch.column(name)[i].as_buffer(), "<u4").astype(np.uint64)


def _in_parts(found: list[tuple[np.ndarray, int, np.ndarray]], limit: int = 1 << 20):
    """``headed`` batches from (keys, document, positions) of documents in a row."""
    lo = 0
    while lo < len(found):
        hi, size = lo, 0
        while hi < len(found) and (hi == lo or size + len(found[hi][0]) <= limit):
            size += len(found[hi][0])
            hi += 1
        part = found[lo:hi]
        yield headed(np.concatenate([k for k, _, _ in part]), np.repeat([d for _, d, _ in part], [len(k) for k, _, _ in part]), np.concatenate([p for _, _, p in part]))
        lo = hi


def equal_windows(work: DataFrame) -> DataFrame:
    """``headed`` hashes of all passages of LEAST words that hold a shared place; pos is where one begins."""

    def run(batches):
        for batch in batches:
            found = []
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                codes, places = _codes(batch, "words", i), _column(batch, "places", i)
                starts = np.zeros(len(codes) + 1, np.int64)
                np.add.at(starts, np.maximum(places + SHINGLE - LEAST, 0), 1)
                np.add.at(starts, places + 1, -1)
                begin = np.flatnonzero(np.cumsum(starts)[: max(0, len(codes) - LEAST + 1)] > 0)
                if len(begin):
                    (hashes,) = X.span_hashes(X.mix(codes + X.U(1)), begin, begin + LEAST)
                    found.append((hashes, doc, begin))
            yield from _in_parts(found)

    return work.mapInArrow(run, HEADED)


def runs_of(equal: DataFrame) -> DataFrame:
    """doc_id, begins and ends of the runs of words that the passages from ``starts`` on make, and others."""

    def run(batches):
        for batch in batches:
            begins, ends = [], []
            for i in range(batch.num_rows):
                starts = np.sort(_column(batch, "starts", i))
                new = np.flatnonzero(np.diff(starts) > LEAST) + 1
                begins.append(starts[np.append(0, new)])
                ends.append(starts[np.append(new - 1, len(starts) - 1)] + LEAST)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(x, pa.list_(pa.int64())) for x in (begins, ends)], batch.column("others")],
                names=["doc_id", "begins", "ends", "others"],
            )

    return equal.mapInArrow(run, "doc_id long, begins array<long>, ends array<long>, others array<long>")


def paragraph_keys(open_work: DataFrame) -> DataFrame:
    """``headed`` MinHash bands of the paragraphs at shared places that lie in no equal passage.

    The paragraphs of a place are the LEAST words from it on and the LEAST words up to it; its own shingle is part
    of their keys, so that only paragraphs of the same place meet. Lines of LEAST words or more that hold a place are
    paragraphs too. The NEXT words of a place are a key by themselves, for passages whose parts stand in another
    order. pos is the place, or the beginning of the line.
    """

    def run(batches):
        for batch in batches:
            found = []
            for i, doc in enumerate(batch.column("doc_id").to_pylist()):
                codes, places = X.mix(_codes(batch, "words", i) + X.U(1)), _column(batch, "places", i)
                shingles = _row_shingles(codes)
                if batch.column("begins")[i].is_valid:
                    begins, ends = _column(batch, "begins", i), _column(batch, "ends", i)
                    at = np.searchsorted(begins, places, "right") - 1
                    places = places[(at < 0) | (places >= ends[at])]
                if not len(places):
                    continue
                lines = np.append(_column(batch, "lines", i), len(codes)).astype(np.int64)
                of = X.distinct(np.searchsorted(lines, places, "right") - 1)
                of = of[(lines[of + 1] - lines[of] >= LEAST)]
                size = LEAST - SHINGLE + 1
                begin = np.concatenate([places, np.maximum(places + 1 - size, 0), lines[of]])
                end = np.concatenate([np.minimum(places + size, len(shingles)), places + 1, np.minimum(lines[of + 1] - SHINGLE + 1, len(shingles))])
                salt = np.concatenate([shingles[places], ~shingles[places], np.zeros(len(of), np.uint64)])
                at = np.concatenate([[0], np.cumsum(end - begin)])
                flat = shingles[np.repeat(begin - at[:-1], end - begin) + np.arange(at[-1])]
                mins = min_hashes(flat, at, BANDS * ROWS).reshape(BANDS, ROWS, -1)
                keys = []
                for b in range(BANDS):
                    key = X.mix(salt + X.U(b + 1))
                    for r in range(ROWS):
                        key = X.mix(key * X.U(X.ODD) + mins[b, r].astype(np.uint64))
                    keys.append(key)
                keys += X.span_hashes(codes, places, np.minimum(places + NEXT, len(codes)))
                at = np.concatenate([places, places, lines[of]])
                found.append((np.concatenate(keys), doc, np.concatenate([np.tile(at, BANDS), places])))
            yield from _in_parts(found)

    return open_work.mapInArrow(run, HEADED)


def _stretches(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the shingles of stretches of words, and their offsets."""
    raw = [np.frombuffer(x.as_buffer(), "<u4") for x in column]
    words = X.mix(np.concatenate([np.zeros(0, "<u4"), *raw]).astype(np.uint64) + X.U(1))
    codes, at = X.shingles(words, np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)]), SHINGLE)
    return X.mix(codes), at


class _Side:
    """The shingles around the places of a batch on one side, row by row: those from ``first`` up to ``n`` count."""

    def __init__(self, batch: pa.RecordBatch, column: str):
        self.codes, self.at = _stretches(batch.column(column))
        self.n = np.diff(self.at)
        self.first = np.zeros(len(self.n), np.int64)
        self.row = np.repeat(np.arange(len(self.n)), self.n)
        self.column = np.arange(len(self.codes)) - self.at[self.row]
        self.keys = (self.row.astype(np.uint64) << np.uint64(52)) | (self.codes >> np.uint64(12))
        self.width = int(self.n.max(initial=1))

    def counts(self) -> np.ndarray:
        return (self.column >= self.first[self.row]) & (self.column < self.n[self.row])

    def found_in(self, other: _Side, to: np.ndarray | None = None) -> np.ndarray:
        """Which shingles the other side has in the same row, up to ``to`` of its shingles."""
        keys = other.keys[other.counts() & (other.column < to[other.row] if to is not None else True)]
        keys = np.sort(keys)
        if not len(keys):
            return np.zeros(len(self.keys), bool)
        return keys[np.minimum(np.searchsorted(keys, self.keys), len(keys) - 1)] == self.keys

    def cut(self, has: np.ndarray, at: np.ndarray, cost: int) -> tuple[np.ndarray, np.ndarray]:
        """Row by row the stretch around ``at`` with the highest sum of 1 for shingles it has and -cost for others."""
        value = np.zeros((len(self.n), self.width + 1), np.int32)
        value[self.row, self.column + 1] = np.where(has, 1, -cost)
        sums = np.cumsum(value, 1, dtype=np.int32)
        place = np.arange(self.width + 1)[None]
        left = np.where((place <= at[:, None]) & (place >= self.first[:, None]), sums, np.iinfo(np.int32).max).argmin(1)
        right = np.where((place > at[:, None]) & (place <= self.n[:, None]), sums, np.iinfo(np.int32).min).argmax(1)
        return left, right

    def part(self, start: np.ndarray, stop: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes and offsets of a stretch of some rows; the others are empty."""
        inside = rows[self.row] & (self.column >= start[self.row]) & (self.column < stop[self.row])
        return self.codes[inside], np.concatenate([[0], np.cumsum(np.bincount(self.row[inside], minlength=len(self.n)))])


def _around(part: pa.RecordBatch, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and stop, in words, of the similar passage around one place of every row; 0 and 0 without one."""
    doc, begin, other, other_begin, shift = (part.column(c).to_numpy() for c in ("doc_id", "from", "other", "other_from", "shift"))
    a, b = _Side(part, "near"), _Side(part, "other_near")
    p, q = pos - begin, pos - shift - other_begin
    a.first, b.first = np.maximum(p - AROUND, 0), np.maximum(q - AROUND, 0)
    a.n, b.n = np.minimum(a.n, p + AROUND - SHINGLE + 1), np.minimum(b.n, q + AROUND - SHINGLE + 1)
    usable = (p < a.n) & (q < b.n)
    p, q = np.where(usable, p, 0), np.where(usable, q, 0)
    same = usable & (doc == other)
    if same.any():
        # In one text the other passage ends before this one begins, which what lies before both places tells.
        s, _ = a.cut(a.found_in(b, to=q + 1), p, COSTS[-1])
        a.first = np.where(same, s, a.first)
        b.n = np.where(same, np.clip(begin + s - SHINGLE + 1 - other_begin, 0, b.n), b.n)
        usable &= q < b.n
        q = np.where(usable, q, 0)
    in_b, in_a = a.found_in(b), b.found_in(a)
    start, stop = np.zeros(len(p), np.int64), np.zeros(len(p), np.int64)
    for cost in COSTS:
        (s, t), (u, v) = a.cut(in_b, p, cost), b.cut(in_a, q, cost)
        some = usable & (np.minimum(t - s, v - u) >= LEAST - SHINGLE + 1) & (t - s > stop - start)
        n_a, n_b, both = overlaps(*a.part(s, t, some), *b.part(u, v, some))
        good = some & (both * (NUM + DEN) >= (n_a + n_b) * NUM)
        start, stop = np.where(good, s, start), np.where(good, t, stop)
    good = stop > 0
    return np.where(good, begin + start, 0), np.where(good, begin + stop + SHINGLE - 1, 0)


def _reach(row: np.ndarray, column: np.ndarray, value: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Highest sum of the values of a stretch of a similar passage's length, over a place from ``first`` to ``last``, of every row."""
    size = LEAST - SHINGLE + 1
    width = max(int(column.max(initial=0)) + 1, size)
    sums = np.full((len(first), width + 1), -1 << 16, np.int32)
    sums[:, 0] = 0
    sums[row, column + 1] = value
    np.cumsum(sums, 1, out=sums)
    low = np.minimum.accumulate(sums, 1)
    stop = np.arange(size, width + 1)[None]
    start = np.clip(np.minimum(stop - size, last[:, None]), 0, width)
    return np.where(stop > first[:, None], sums[:, size:] - np.take_along_axis(low, start, 1), -1 << 16).max(1)


def _buckets(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, position and bucket of every shingle of some stretches, and whether it is the last of its bucket; equal shingles have equal buckets."""
    raw, offsets = X.buffers(column)
    words, ends = raw.view("<u4"), offsets // 4
    sums = np.zeros(len(words), np.uint32)
    for k, factor in enumerate(X.random_codes(SHINGLE).astype(np.uint32) | np.uint32(1)):
        sums[: max(0, len(words) - k)] += words[k:] * factor
    row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    at = np.arange(len(words))
    whole = at + SHINGLE <= ends[1:][row]
    row, at = row[whole], at[whole] - ends[row[whole]]
    bucket = row * QUICK + (sums[whole] >> np.uint32(32 - (QUICK - 1).bit_length()))
    latest = np.empty((len(ends) - 1) * QUICK, np.int32)
    latest[bucket] = at
    return row, at, bucket, latest[bucket] == at


def _may_hold(part: pa.RecordBatch) -> np.ndarray:
    """Whether a row of ``_verified`` may have a passage: the others certainly have not.

    On each side one needs FEWEST shingles that the other side has, and on both together a stretch over a place with
    four common ones for each one that one side lacks. Buckets tell them, so some count that the other side lacks.
    """
    places = part.column("places")
    pos, at = places.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pc.list_value_length(places).to_numpy())])
    first, last = (f.reduceat(pos, at[:-1]) if len(pos) else pos for f in (np.minimum, np.maximum))
    begin, other_begin, shift = (part.column(c).to_numpy() for c in ("from", "other_from", "shift"))
    sides = [(_buckets(part.column(c)), begins) for c, begins in (("near", begin), ("other_near", other_begin + shift))]
    may, both = np.ones(part.num_rows, bool), np.zeros(part.num_rows, np.int64)
    for ((row, column, own, latest), begins), ((_, _, other, _), _) in (sides, sides[::-1]):
        has = np.zeros(part.num_rows * QUICK, bool)
        has[other] = True
        hit = has[own]
        may &= np.bincount(row[hit], minlength=part.num_rows) >= FEWEST
        # What is common counts once on either side, what the other side lacks twice, each one of a set once.
        both += _reach(row, column, np.where(hit, 1, np.where(latest, -2 * NUM // (DEN - NUM), 0)), first - begins, last - begins)
    return may & (both >= 0)


def _verified(part: pa.RecordBatch) -> pa.RecordBatch:
    """(doc_id, start, stop, other) of the passages of pairs of stretches of text, around each of their ``places``.

    A place that only shared shingles part from the one before has the same passage, as a stretch with the highest
    sum takes both or none; a place inside a passage that was found needs no search either.
    """
    part = part.filter(pa.array(_may_hold(part)))
    a, b = _Side(part, "near"), _Side(part, "other_near")
    hit_a, hit_b = a.found_in(b), b.found_in(a)
    hits = [np.bincount(x.row[h], minlength=len(x.n)) for x, h in ((a, hit_a), (b, hit_b))]
    lacks_a, lacks_b = (np.append(0, np.cumsum(~h)) for h in (hit_a, hit_b))
    doc, begin, other, other_begin, shift = (part.column(c).to_numpy() for c in ("doc_id", "from", "other", "other_from", "shift"))
    left: dict[int, list[int]] = {}
    for i in np.flatnonzero(np.minimum(*hits) >= FEWEST).tolist():
        pos = np.sort(part.column("places")[i].values.to_numpy(zero_copy_only=False))
        x, y = a.at[i] + np.minimum(pos - begin[i], a.n[i]), b.at[i] + np.minimum(pos - shift[i] - other_begin[i], b.n[i])
        joined = (lacks_a[x[1:]] == lacks_a[x[:-1]]) & (lacks_b[y[1:]] == lacks_b[y[:-1]]) & (hit_a[np.minimum(x[1:], len(hit_a) - 1)])
        left[i] = pos[np.append(True, ~joined | (doc[i] == other[i]))].tolist()
    out = []
    while left:
        rows = np.array(list(left))
        start, stop = _around(part.take(pa.array(rows)), np.array([left[i].pop(0) for i in left]))
        for i, s, t in zip(rows.tolist(), start.tolist(), stop.tolist()):
            if t:
                out.append((int(doc[i]), s, t, int(other[i])))
                left[i] = [p for p in left[i] if not s <= p < t]
        left = {i: at for i, at in left.items() if at}
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else ((),) * 4)], names=["doc_id", "start", "stop", "other"])


PASSAGES = "doc_id long, start long, stop long, other long"


def _near(rows: DataFrame, words: DataFrame, doc: str, first: str, last: str, start: str, near: str) -> DataFrame:
    """The rows with the words of ``doc`` from AROUND before ``first`` up to AROUND behind ``last``, and where they start."""
    rows = rows.join(words.withColumnsRenamed({"doc_id": doc, "words": "_words"}), doc)
    rows = rows.withColumn(start, F.greatest(F.col(first) - AROUND, F.lit(0)))
    part = F.substring("_words", (F.col(start) * 4 + 1).cast("int"), ((F.col(last) + AROUND - F.col(start)) * 4).cast("int"))
    return rows.withColumn(near, part).drop("_words")


def diagonals(pairs: DataFrame) -> DataFrame:
    """Pairs of places (doc_id, pos, other, other_pos) as (doc_id, other, shift, places): those of a diagonal that stand close together."""
    close = [F.col("doc_id"), F.col("other"), (F.col("pos") - F.col("other_pos")).alias("shift"), F.floor(F.col("pos") / APART).alias("block")]
    return pairs.groupBy(*close).agg(F.collect_set("pos").alias("places")).drop("block")


def similar_passages(pairs: DataFrame, work: DataFrame) -> DataFrame:
    """(doc_id, start, stop, other) of the passages around ``diagonals`` whose exact Jaccard similarity reaches NUM / DEN.

    Within AROUND words of a place both sides are cut to where most shingles occur on the other side
    too, in whatever order; cuts are tried for several costs of other shingles, the longest that holds counts.
    Every place of a diagonal that is in no passage found before is tried.
    """

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                yield _verified(batch.slice(lo, 1024))

    words = work.select("doc_id", "words")
    ids = pairs.select(F.explode(F.array("doc_id", "other")).alias("id")).distinct()
    words = screened(words, stored(ids), "doc_id")
    rows = pairs.withColumns({"_first": F.array_min("places"), "_last": F.array_max("places")})
    rows = _near(rows, words, "doc_id", "_first", "_last", "from", "near")
    rows = rows.withColumns({"_first": F.col("_first") - F.col("shift"), "_last": F.col("_last") - F.col("shift")})
    rows = _near(rows, words, "other", "_first", "_last", "other_from", "other_near").drop("_first", "_last")
    return rows.mapInArrow(run, PASSAGES).distinct()


def _best(side: _Side, at: np.ndarray, token: np.ndarray, other: _Side, other_token: np.ndarray) -> np.ndarray:
    """Highest sum, for each place of a side and each one of the other, as in ``_may_hold``."""
    size = LEAST - SHINGLE + 1
    out = np.full((len(side.n), len(other.n)), -1 << 14, np.int16)
    n = int(max(token.max(initial=-1), other_token.max(initial=-1))) + 1
    both = np.zeros(n + 1, bool)
    both[np.intersect1d(token, other_token)] = True
    number = np.cumsum(both) * both  # of the tokens of both sides; 0 is any other
    step = max(1, (1 << 25) // (int(number.max(initial=0)) + 1))
    for lo in range(0, len(other.n), step):
        inside = slice(other.at[lo], other.at[min(lo + step, len(other.n))])
        has = np.zeros((int(number.max(initial=0)) + 1, min(step, len(other.n) - lo)), bool)
        has[number[other_token[inside]], other.row[inside] - lo] = True
        has[0] = False
        for i in np.flatnonzero((side.n >= size) & (at < side.n)).tolist():
            own = token[side.at[i] : side.at[i + 1]]
            cost = np.zeros(len(own), np.int16)
            cost[np.unique(own, return_index=True)[1]] = -2 * NUM // (DEN - NUM)
            sums = np.zeros((len(own) + 1, has.shape[1]), np.int16)
            np.cumsum(np.where(has[number[own]], np.int16(1), cost[:, None]), 0, out=sums[1:])
            low = np.minimum.accumulate(sums[: min(int(at[i]), len(own) - size) + 1], 0)
            stop = np.arange(max(size, int(at[i]) + 1), len(own) + 1)
            out[i, lo : lo + step] = (sums[stop] - low[np.minimum(stop - size, len(low) - 1)]).max(0)
    return out


def _may_be_similar(left: _Side, left_at: np.ndarray, right: _Side, right_at: np.ndarray) -> np.ndarray:
    """Whether two places may have similar passages, from the shingles of their surroundings; the others certainly have none."""
    _, token = np.unique(np.concatenate([left.codes, right.codes]) >> X.U(12), return_inverse=True)
    sides = (left, left_at, token[: len(left.codes)]), (right, right_at, token[len(left.codes) :])
    best = _best(*sides[0], sides[1][0], sides[1][2])
    back = best if left is right else _best(*sides[1], sides[0][0], sides[0][2])
    return best + back.T >= 0


def _searched(found: pa.Table) -> pa.Table:
    """(doc_id, start, stop, other) of the similar passages around any two places of a key that meet in a bucket of ``tiled``.

    Pairs of one component whose later place lies in a passage found already are left out.
    """
    doc, pos, begin, component = (found.column(c).to_numpy() for c in ("doc_id", "pos", "from", "component"))
    done, label = found.column("settled").to_numpy().copy(), component.copy()
    near = found.column("near").combine_chunks()
    out = []
    for left, right in groups_of(found):
        one = _Side(pa.table({"near": near.take(pa.array(left))}), "near")
        two = one if left is right else _Side(pa.table({"near": near.take(pa.array(right))}), "near")
        ok = _may_be_similar(one, (pos - begin)[left], two, (pos - begin)[right])
        for x in np.lexsort((pos[left], doc[left])).tolist():
            one = int(left[x])
            others = right[ok[x]]
            before = (doc[others] < doc[one]) | ((doc[others] == doc[one]) & (pos[others] < pos[one]))
            if left is right:  # each pair once, by its earlier place
                others, before = others[~before & (others != one)], np.zeros(int((~before & (others != one)).sum()), bool)
            late, early = np.where(before, one, others), np.where(before, others, one)
            open_ = (label[late] != label[early]) | ~done[late]
            late, early = late[open_], early[open_]
            for lo in range(0, len(late), 1024):
                y, z = late[lo : lo + 1024], early[lo : lo + 1024]
                part = pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc[y]), pa.array(begin[y]), near.take(pa.array(y)), pa.array(doc[z]), pa.array(begin[z]), near.take(pa.array(z)),
                        pa.array(pos[y] - pos[z]), pa.array(list(pos[y][:, None])),
                    ],
                    names=["doc_id", "from", "near", "other", "other_from", "other_near", "shift", "places"],
                )
                passages = list(zip(*(c.to_pylist() for c in _verified(part).columns)))
                out += passages
                by = {}
                for d, s, t, o in passages:
                    by.setdefault((d, o), []).append((s, t))
                for u, v in zip(y.tolist(), z.tolist()):
                    spans = by.get((doc[u], doc[v]), ())
                    if spans:
                        label[label == label[u]] = label[v]
                        done[u] |= any(s <= pos[u] < t for s, t in spans)
    names = ["doc_id", "start", "stop", "other"]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, zip(*set(out)) if out else ((),) * 4)})


def frequencies(texts: DataFrame) -> np.ndarray:
    """How often the shingles ``near`` places occur, by BINS of their codes; the driver gets a row for each bin at most."""

    def run(batches):
        n = np.zeros(BINS, np.int64)
        for batch in batches:
            codes, _ = _stretches(batch.column("near"))
            n += np.bincount((codes >> X.U(12)).astype(np.int64) % BINS, minlength=BINS)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at])], names=["bin", "n"])

    got = texts.select("near").mapInArrow(run, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(BINS, np.int32)
    out[got.column("bin").to_numpy()] = np.minimum(got.column("n").to_numpy(), np.iinfo(np.int32).max)
    return out


def rare_shingles(places: DataFrame, often: np.ndarray) -> DataFrame:
    """(key, place): a key for each rare shingle ``near`` a place, of which similar places of a family share one.

    With shingles in one order, by their number, the rarest one that two places share has at least FEWEST - 1 more of
    the shared ones behind it, on both sides. So the last FEWEST - 1 of a place, the most common, need no key.
    """
    shared = places.sparkSession.sparkContext.broadcast(often)

    def run(batches):
        often = shared.value
        for batch in batches:
            for lo in range(0, batch.num_rows, 1024):
                part = batch.slice(lo, 1024)
                codes, at = _stretches(part.column("near"))
                codes = codes >> X.U(12)  # as far as ``_Side`` compares them
                n, row = often[codes.astype(np.int64) % BINS], np.repeat(np.arange(part.num_rows), np.diff(at))
                order = np.lexsort((codes, n, row))
                left = at[1:][row] - np.arange(len(row))  # shingles of the row from here on, by number
                rare = (left >= FEWEST) & (n[order] > 1)
                codes, row = codes[order][rare], row[rare]
                new = np.ones(len(codes), bool)
                new[1:] = (codes[1:] != codes[:-1]) | (row[1:] != row[:-1])
                codes, row = codes[new], row[new]
                key = X.mix(X.mix(part.column("family").to_numpy().view(np.uint64)[row]) + codes)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(part.column("place").to_numpy()[row])], names=["key", "place"])

    return places.select("family", "place", "near").mapInArrow(run, "key long, place long")


def open_pairs(rows: DataFrame, *further: str) -> DataFrame:
    """Pairs of places of a key, but those of one component whose later place lies in a passage found; ``further`` columns of both."""
    early = rows.select("key", *[F.col(c).alias(f"other_{c}") for c in ("pos", "component", *further)], F.col("doc_id").alias("other"))
    pairs = rows.join(early, "key").where((F.col("other") < F.col("doc_id")) | ((F.col("other") == F.col("doc_id")) & (F.col("other_pos") < F.col("pos"))))
    return pairs.where((F.col("component") != F.col("other_component")) | ~F.col("settled"))


def pairs_of_large_keys(large: DataFrame, texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs (doc_id, pos, other, other_pos) of large keys that may be similar, and families with pairs not among them.

    Keys whose places begin with one shingle make a family, so that the shingles ``near`` a place are dealt
    out once. Only places of a family that share a rare shingle are paired. The families (key, doc_id, pos, component,
    settled) that are left hold the places of rare shingles that more than FEW places share.
    """
    root = F.xxhash64(F.substring("near", ((F.col("pos") - F.col("from")) * 4 + 1).cast("int"), F.lit(4 * SHINGLE)))
    rooted = stored(large.join(texts.select("doc_id", "pos", root.alias("root")), ["doc_id", "pos"]))
    families = rooted.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    families = families.select("key", F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(F.col("key")).alias("family"))
    members = rooted.join(families, "key").groupBy("family", "doc_id", "pos")
    members = stored(members.agg(F.collect_set("key").alias("keys"), F.max("component").alias("component"), F.max("settled").alias("settled")))
    named = members.withColumn("place", F.xxhash64("family", "doc_id", "pos"))
    rare = rare_shingles(named.select("family", "place", "doc_id", "pos").join(texts, ["doc_id", "pos"]), frequencies(texts))
    shared = stored(rare.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("key"))).where("n > 1"))
    few = open_pairs(shared.where(F.col("n") <= FEW).join(named, "place"), "keys").where(F.arrays_overlap("keys", "other_keys"))
    many = shared.where(F.col("n") > FEW).select("place").distinct().join(named, "place").select(F.col("family").alias("key"), "doc_id", "pos", "component", "settled")
    facts = many.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.min("settled").alias("closed"))
    many = stored(many.join(facts.where("lo < hi or not closed").select("key"), "key"))
    return few.select("doc_id", "pos", "other", "other_pos").distinct(), many


def rest_of_keys(led: DataFrame, near: DataFrame, links: DataFrame, work: DataFrame) -> DataFrame:
    """The similar passages around two places of a key that ``first_places`` has not held against each other; stored.

    Left out are pairs of documents that ``links`` connect already, whose later place lies in a passage of ``near``. The
    pairs of keys with up to FEW places are rows. Those of larger keys are rows when they share a rare shingle, as
    similar places do; places whose rare shingles very many share are searched in tiles of bounded size inside tasks.
    """
    with scratch(work.sparkSession) as keep:
        rest = led.select("key", "doc_id", "pos", F.struct("other", "other_pos").alias("held"))
        firsts = led.select("key", F.col("other").alias("doc_id"), F.col("other_pos").alias("pos"), F.lit(None).cast(rest.schema["held"].dataType).alias("held"))
        several = led.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
        rest = rest.union(firsts).join(several, "key").groupBy("key", "doc_id", "pos").agg(F.max("held").alias("held"))
        runs = near.groupBy("doc_id").agg(F.collect_set(F.struct("start", "stop")).alias("runs"))
        inside = F.exists("runs", lambda r: (r["start"] <= F.col("pos")) & (F.col("pos") < r["stop"]))
        known = components(links).select(F.col("id").alias("doc_id"), "component")
        rest = rest.join(runs, "doc_id", "left").join(known, "doc_id", "left")
        rest = stored(rest.select("key", "doc_id", "pos", "held", F.coalesce("component", "doc_id").alias("component"), F.coalesce(inside, F.lit(False)).alias("settled")))
        facts = rest.groupBy("key").agg(
            F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n"),
            F.max(F.col("held").isNotNull() & ~F.col("settled")).alias("open"),
        )
        rest = stored(rest.join(facts.where("n > 2 and (lo < hi or open)").select("key", "n"), "key"))
        small = rest.where(F.col("n") <= FEW).drop("n")
        pairs = open_pairs(small).where(~F.col("held").eqNullSafe(F.struct("other", "other_pos"))).select("doc_id", "pos", "other", "other_pos")
        large = rest.where(F.col("n") > FEW).select("key", "doc_id", "pos", "component", "settled")
        if large.isEmpty():
            return keep(similar_passages(stored(diagonals(pairs)), work))
        places = large.select("doc_id", "pos").distinct()
        texts = screened(work.select("doc_id", "words"), stored(places.select(F.col("doc_id").alias("at")).distinct()), "doc_id")
        texts = stored(_near(places, texts, "doc_id", "pos", "pos", "from", "near"))
        few, many = pairs_of_large_keys(large, texts)
        found = similar_passages(stored(diagonals(pairs.union(few))), work)
        if not many.isEmpty():
            id = F.struct("doc_id", "pos").alias("id")
            cross = tiled(many.select("key", id, "component", "settled"), texts.select(id, "doc_id", "pos", "from", "near"), gathered=256).drop("id")
            parts = int(work.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # small rows with much work: not put together by size
            found = found.union(cross.repartition(parts, "bucket").groupBy("bucket").applyInArrow(_searched, PASSAGES)).distinct()
        return keep(found)


def repeats(documents: DataFrame) -> DataFrame:
    """(doc_id, spans, others) of the documents with passages that an earlier place has, by doc_id and position; stored.

    All passages of LEAST words that are equal to an earlier one are found by their hashes; as
    equal passages share a place, only passages that hold a shared place are hashed. Places outside of those are
    held, by bands of the paragraphs beside them, against the first such place, and then against all others of their key
    as far as they lie in no passage found, or in documents not connected yet; the passages found so count when their
    exact Jaccard similarity reaches NUM / DEN. ``spans`` are both as (start, stop) in words, ``others`` the documents
    that have the earlier passages.
    """
    with scratch(documents.sparkSession) as keep:
        places = shared_places(bands(documents))
        work = stored(worked(documents, places))
        equal = first_places(equal_windows(work))
        # In one text the earlier passage has to end before.
        equal = equal.where((F.col("other") < F.col("doc_id")) | (F.col("pos") - F.col("other_pos") >= LEAST))
        equal = equal.groupBy("doc_id").agg(F.collect_set("pos").alias("starts"), F.collect_set("other").alias("others"))
        equal = stored(runs_of(equal))
        open_work = work.join(equal.select("doc_id", "begins", "ends"), "doc_id", "left")
        led = stored(first_places(paragraph_keys(open_work)))
        near = stored(similar_passages(stored(diagonals(led)), work))
        links = equal.select(F.explode("others").alias("a"), F.col("doc_id").alias("b")).union(near.select(F.col("other").alias("a"), F.col("doc_id").alias("b")))
        near = near.union(rest_of_keys(led, near, links, work)).distinct()
        near = near.groupBy("doc_id").agg(F.collect_set(F.struct("start", "stop")).alias("runs"), F.collect_set("other").alias("near_others"))
        found = equal.join(near, "doc_id", "full")
        others = F.array_union(F.coalesce("others", F.array()), F.coalesce("near_others", F.array()))
        equal_runs = F.transform(F.arrays_zip("begins", "ends"), lambda r: F.struct(r["begins"].alias("start"), r["ends"].alias("stop")))
        spans = F.sort_array(F.array_union(F.coalesce(equal_runs, F.array()), F.coalesce("runs", F.array())))
        return keep(found.select("doc_id", spans.alias("spans"), others.alias("others")))


def deduplicated(documents: DataFrame) -> DataFrame:
    """The documents, all columns, with ``text`` less its repeated passages, and what went.

    A passage of 50 words or more goes when an earlier place (smaller doc_id, or before it in the same text)
    has it too, equal or with a Jaccard similarity of 0.8 on five-word shingles; words are runs of characters
    other than white space, A-Z like a-z. Every removed passage has a verified earlier one, so the first of
    each class of passages stays. Equal passages are found without exception, up to their first and last word; similar
    ones by MinHash bands, within AROUND words to each side of a place that both have. Further columns: n_words, n_removed (words),
    spans (start and stop, in words) and component_id, the smallest doc_id reachable through shared passages.
    Null texts are empty; texts without repeated passages stay as they are. Each row is a document of its own:
    of several rows of a doc_id the first by a hash of its text has that place, further ones and rows without
    doc_id come behind all others (``identified``); a class of such rows alone has their smallest doc_id, null without one.
    The added columns get underscores behind their names where the table has those names already.
    """
    source, own, plain = identified(documents)
    key, cuts, group = (fresh([*documents.columns, own], c) for c in ("key", "cuts", "group"))
    with scratch(documents.sparkSession) as keep:
        texts = source.select(F.col(own).alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
        found = repeats(texts)
        spans = found.select("doc_id", "spans")
        classes = components(found.select(F.explode("others").alias("a"), F.col("doc_id").alias("b")))
        if not plain:  # classes are named by doc_id
            ids = source.select(F.col(own).alias("id"), F.col("doc_id").cast("long").alias("name"))
            named = ids.join(classes, "id", "left").withColumn("component", F.coalesce("component", "id"))
            least = named.groupBy("component").agg(F.min("name").alias("least"))
            classes = named.join(least, "component").select("id", F.col("least").alias("component"))
        facts = spans.join(classes.select(F.col("id").alias("doc_id"), "component"), "doc_id", "full")
        facts = keep(facts.select(F.col("doc_id").alias(key), F.col("spans").alias(cuts), F.col("component").alias(group)))
    rows = source.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = with_facts(rows, facts, own)
    kept = [c for c in documents.columns if c != "text"]
    names = {c: f"c{i}" for i, c in enumerate(kept)}  # other columns may have any name
    shape = rows.select(
        *[F.col(f"`{c}`").alias(n) for c, n in names.items()], F.col("text").alias("_text"), F.col(cuts).alias("_spans"),
        F.coalesce(group, F.col("doc_id").cast("long")).alias("_component"),
    )

    def cut(batches):
        for batch in batches:
            texts, n_words, n_removed, out_spans = [], [], [], []
            for text, spans in zip(batch.column("_text").to_pylist(), batch.column("_spans").to_pylist()):
                merged: list[list[int]] = []
                for s in spans or []:
                    if merged and s["start"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s["stop"])
                    else:
                        merged.append([s["start"], s["stop"]])
                raw = text.encode()
                at = X.word_spans(raw)
                pieces, last = [], 0
                for start, stop in merged:
                    pieces.append(raw[last : at[start, 0]])
                    last = int(at[stop - 1, 1])
                pieces.append(raw[last:])
                texts.append(b"".join(pieces).decode() if merged else text)
                n_words.append(len(at))
                n_removed.append(sum(b - a for a, b in merged))
                out_spans.append(merged)
            columns = [batch.column(n) for n in names.values()]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(out_spans, pa.list_(pa.list_(pa.int64()))), batch.column("_component")],
                names=[*names.values(), "_text", "n_words", "n_removed", "spans", "component_id"],
            )

    given = ", ".join(f"{n} {shape.schema[n].dataType.simpleString()}" for n in names.values())
    out = shape.mapInArrow(cut, f"{given}, _text string, n_words long, n_removed long, spans array<array<long>>, component_id long")
    back = [F.col("_text").alias("text") if c == "text" else F.col(names[c]).alias(c) for c in documents.columns]
    added = [F.col(c).alias(fresh(documents.columns, c)) for c in ("n_words", "n_removed", "spans", "component_id")]
    return out.select(*back, *added)


def passage_digests(documents: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, spans, component_id, n_chars and SHA-256 of the text left; stored."""
    with scratch(documents.sparkSession) as keep:
        rows = deduplicated(document_rows(documents))
        return keep(rows.select(
        "doc_id", "n_words", "n_removed", F.to_json("spans").alias("spans"), "component_id",
        F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"),
        ))
