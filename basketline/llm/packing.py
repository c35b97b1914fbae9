"""Packing of documents into windows by lexical retrieval from BM25 indexes, sharded by content."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketline.llm import textcodes as X
from basketline.llm.bpe import codec
from basketline.llm.common import document_rows, scratch, stored

BUCKETS = 1 << 18  # hashed vocabulary of the index: its statistics have a fixed size
COMMON = 16  # terms that one in so many documents of a shard has are held as rows of weights
END = 1  # id that ends a document
K1, B = 1.2, 0.75


def termed(rows: DataFrame) -> DataFrame:
    """The rows with a number, their distinct hashed terms with counts, their words and bytes; texts are read once, here."""

    def run(batches):
        for big in batches:
            for batch in X.slices(big, "text"):
                texts = batch.column("text")
                codes, at = X.words(texts)
                row = np.repeat(np.arange(batch.num_rows), np.diff(at)).astype(X.U)
                distinct, counts = np.unique((row << X.U(32)) + (codes & X.U(BUCKETS - 1)), return_counts=True)
                ends = np.searchsorted(distinct, np.arange(batch.num_rows + 1).astype(X.U) << X.U(32)).tolist()
                terms = (distinct & X.U(BUCKETS - 1)).astype("<u4").view(np.uint8).reshape(-1, 4)[:, :3]  # 18 bits in three bytes
                counts = np.minimum(counts, 65535).astype("<u2")  # a weight does not change beyond
                lists = [pa.array([v[a:b].tobytes() for a, b in zip(ends, ends[1:])], pa.binary()) for v in (terms, counts)]
                sizes = [pa.array(np.diff(at)), pa.array(np.diff(X.buffers(texts)[1]))]
                yield pa.RecordBatch.from_arrays([*batch.columns, *lists, *sizes], names=["doc_id", "text", "row", "terms", "counts", "words", "size"])

    rows = rows.withColumn("row", F.monotonically_increasing_id())
    return rows.mapInArrow(run, "doc_id long, text string, row long, terms binary, counts binary, words long, size long")


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary column, and where each row ends in them."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.uint8), np.cumsum([len(t.as_buffer()) for t in column], dtype=np.int64)[:-1]


def _terms(column: pa.Array) -> list[np.ndarray]:
    """The terms of each row."""
    if not len(column):
        return []
    raw, ends = _bytes(column)
    wide = np.zeros((len(raw) // 3, 4), np.uint8)
    wide[:, :3] = raw.reshape(-1, 3)
    return np.split(wide.view("<i4").ravel(), ends // 3)


def _counts(column: pa.Array) -> list[np.ndarray]:
    """How often each row has its terms."""
    raw, ends = _bytes(column)
    return np.split(raw.view("<u2").astype(np.int64), ends // 2)


def statistics(rows: DataFrame) -> tuple[np.ndarray, float]:
    """Inverse document frequency of every hashed term (below 0 for those of one document), and the mean length in words.

    Every task counts its own documents first; the driver gets one row per bucket of the
    hashed vocabulary, however large the table is.
    """

    def run(batches):
        df, words, n = np.zeros(BUCKETS, np.int64), 0, 0
        for batch in batches:
            if batch.num_rows:
                df += np.bincount(np.concatenate(_terms(batch.column("terms"))), minlength=BUCKETS)
                words += int(batch.column("words").to_numpy().sum())
                n += batch.num_rows
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array([*at.tolist(), BUCKETS, BUCKETS + 1], pa.int32()), pa.array([*df[at].tolist(), words, n], pa.int64())], names=["term", "n"]
        )

    got = rows.select("terms", "words").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros(BUCKETS + 2)
    df[got["term"].to_numpy()] = got["n"].to_numpy()
    words, n = df[BUCKETS:]
    df, n = df[:BUCKETS], max(1.0, n)
    idf = np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32)
    return np.where(df == 1, -idf, idf), max(1.0, words / n)


class Index:
    """A BM25 inverted index of one shard; documents leave it when they are used."""

    def __init__(self, documents: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray, mean: float):
        terms, counts = [t for t, _ in documents], [c for _, c in documents]
        self.terms = terms
        self.idf = idf
        sizes = np.array([len(t) for t in terms])
        flat = np.concatenate(terms) if terms else np.zeros(0, np.int32)
        tf = np.concatenate(counts).astype(np.float32) if terms else np.zeros(0, np.float32)
        docs = np.repeat(np.arange(len(terms)), sizes)
        length = np.array([c.sum(dtype=np.int64) for c in counts], np.float32)
        order = np.argsort(flat, kind="stable")
        self.docs = docs[order].astype(np.int32)
        self.distinct, self.begin, self.df = np.unique(flat[order], return_index=True, return_counts=True)
        weight = idf[flat] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[docs] / mean))
        self.weight = weight[order]
        common = np.flatnonzero(self.df * COMMON > len(terms))
        self.row = np.full(len(self.distinct), -1)
        self.row[common] = np.arange(len(common))
        self.rows = np.zeros((len(common), len(terms)), np.float32)
        for row, (a, n) in enumerate(zip(self.begin[common].tolist(), self.df[common].tolist())):
            self.rows[row, self.docs[a : a + n]] = self.weight[a : a + n]
        self.free = np.ones(len(terms), bool)

    def neighbours(self, seed: int, most: int | None = None) -> np.ndarray:
        """Unused documents that share a term with the seed, scored by all its terms, best first; ties by position."""
        at = np.searchsorted(self.distinct, self.terms[seed])
        score = self.rows[self.row[at[self.row[at] >= 0]]].sum(0, dtype=np.float64)
        at = at[self.row[at] < 0]
        size = self.df[at]
        where = np.repeat(self.begin[at] - np.cumsum(size) + size, size) + np.arange(size.sum())
        score += np.bincount(self.docs[where], self.weight[where], minlength=len(score))
        docs = np.flatnonzero((score > 0) & self.free)
        if most and len(docs) > most:
            docs = docs[score[docs] >= np.partition(score[docs], -most)[-most]]
        return docs[np.lexsort((docs, -score[docs]))][:most]


def windows(lengths: np.ndarray, index: Index, window: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, window, offset) of every piece of one shard.

    The seed is the document that the last window cut, or else the longest unused one; its unused
    neighbours follow in the order of their scores, then the next seed, until the window is full.
    """
    out = []  # a window has ``window`` documents at most, so no more neighbours are asked for
    seeds = iter(np.lexsort((np.arange(len(lengths)), -lengths)).tolist())
    at = sequence = 0
    queue: list[int] = []
    left = len(lengths)
    doc, start = -1, 0
    while left or doc >= 0:
        if doc < 0:
            doc = next((d for d in queue if index.free[d]), -1)
            queue = queue[queue.index(doc) + 1 :] if doc >= 0 else []
            if doc < 0:
                doc = next(d for d in seeds if index.free[d])
                queue = []
            index.free[doc] = False
            left -= 1
            start = 0
            if not queue:
                queue = index.neighbours(doc, window).tolist()
        take = min(int(lengths[doc]) - start, window - at)
        out.append((doc, start, take, sequence, at))
        start += take
        at += take
        if start == lengths[doc]:
            doc = -1
        if at == window:
            sequence, at = sequence + 1, 0
            # A new window: neighbours of the document that goes on in it, or of a new seed.
            queue = index.neighbours(doc, window).tolist() if doc >= 0 else []
    return out


def routes_of(terms: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """A term that speaks for the content of each document, BUCKETS for those without one.

    It is a min-hash over the terms that other documents have too, weighted by the square of idf: two
    documents have the same one with a chance of their weighted Jaccard similarity, copies always.
    """
    codes = X.random_codes(BUCKETS)
    draw = -np.log((codes >> X.U(11)).astype(float) / (1 << 53) + 2.0**-54) / np.square(np.maximum(idf, 1e-6).astype(float))
    return np.array([t[draw[t].argmin()] if len(t) else BUCKETS for t in terms], np.int32)


def shard_table(rows: DataFrame, idf: Broadcast, shard_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """First shard of every route and how many it has: small routes share one, larger ones have several of bounded size."""

    def run(batches):
        for batch in batches:
            route = routes_of(_terms(batch.column("terms")), idf.value)
            yield pa.RecordBatch.from_arrays([pa.array(route), batch.column("size")], names=["route", "size"])

    got = rows.select("terms", "size").mapInArrow(run, "route int, size long").groupBy("route").agg(F.sum("size").alias("size")).toPandas()
    size = np.zeros(BUCKETS + 1, np.int64)
    size[got["route"].to_numpy()] = got["size"].to_numpy()
    n = np.maximum(1, -(-size // shard_bytes))
    small = n == 1
    first = np.cumsum(np.where(small, size, 0)) // shard_bytes
    first[~small] = first.max() + 1 + np.cumsum(n[~small]) - n[~small]
    return first, n


def packed(documents: DataFrame, tokenizer: str, window: int = 2048, shard_bytes: int = 4 << 20) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every document, closed by id 1, is cut into pieces that fill windows of ``window`` ids. Documents
    are dealt by content (``routes_of``) over shards of about ``shard_bytes`` of text, so that lexical neighbours meet;
    those of a route with more text are dealt over several shards by hash, so no group is in one task. A shard is an inverted index in one task, weighted by document frequencies of the
    whole table. A window holds the seed and its best unused BM25 neighbours; only the last
    window of a shard may have padding. Null and empty texts are one closing id. Each row is packed,
    repeated rows and rows with a null doc_id too. A document longer than a shard makes it longer.
    """
    spread = documents.sparkSession.sparkContext.broadcast
    with scratch(documents.sparkSession) as keep:
        rows = stored(termed(document_rows(documents)))
        idf, mean = statistics(rows)
        routing, shared_idf = spread(idf), spread(np.abs(idf))  # BUCKETS floats each, whatever the table
        table = spread(np.stack(shard_table(rows, routing, shard_bytes)))
        return keep(_windows(rows, tokenizer, window, mean, routing, shared_idf, table))


def _windows(rows, tokenizer: str, window: int, mean: float, routing: Broadcast, shared_idf: Broadcast, table: Broadcast) -> DataFrame:
    """The pieces of all documents, shard by shard."""

    def dealing(batches):
        first, n = table.value
        for batch in batches:
            route = routes_of(_terms(batch.column("terms")), routing.value)
            shard = pa.array(first[route] + batch.column("salt").to_numpy() % n[route])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("doc_id", "text", "terms", "counts")], shard], names=["doc_id", "text", "terms", "counts", "shard"])

    # Equal rows of a large route would meet in one shard: their numbers tell them apart.
    salted = rows.select("doc_id", "text", "terms", "counts", F.pmod(F.xxhash64("doc_id", "row"), F.lit(1 << 62)).alias("salt"))
    dealt = salted.mapInArrow(dealing, "doc_id long, text string, terms binary, counts binary, shard long")

    def run(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")]).combine_chunks()
        texts = table.column("text").chunk(0)
        words = codec(tokenizer)
        ids = []
        for batch in X.slices(pa.RecordBatch.from_arrays([texts], names=["text"]), "text"):
            found = [np.append(words.expand(s), END) for s in words.slots(batch.column("text").to_pylist())]
            ids += [i.astype(np.uint16) if i.max() < 1 << 16 else i.astype(np.uint32) for i in found]
        lengths = np.array([len(i) for i in ids], np.int64)
        terms, counts = _terms(table.column("terms").chunk(0)), _counts(table.column("counts").chunk(0))
        index = Index(list(zip(terms, counts)), shared_idf.value, mean)
        d, start, n, sequence, offset = (np.array(x, np.int64) for x in zip(*windows(lengths, index, window)))
        crc = [zlib.crc32(ids[i][a : a + k].astype("<u4").tobytes()) for i, a, k in zip(d.tolist(), start.tolist(), n.tolist())]
        return pa.table(
            {
                "doc_id": table.column("doc_id").take(pa.array(d)),
                "start": start,
                "length": n,
                "ids_crc32": pa.array(crc, pa.int64()),
                "doc_tokens": lengths[d],
                "sequence_id": (shard << 32) + sequence,
                "offset": offset,
            }
        )

    return dealt.groupBy("shard").applyInArrow(
        run,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
