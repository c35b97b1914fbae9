"""Exact top-k inner-product search by refining score histograms."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketline.llm.common import stored

BINS = 256
PARTS = 16  # parts that the candidates of one query block are dealt over
SAFE = 1 << 53  # sums below this are exact in double precision
NOWHERE = -(1 << 62)  # below every score: all candidates of the query are among its best
WIDEST = 1 << 61  # largest score that rounds and NOWHERE leave room for
HELD = 64  # histograms of query blocks that a task holds before it hands them on


def whole_vectors(embeddings: DataFrame, scale: int) -> DataFrame:
    """vec_id and floor(scale * x) of each component; rows without a usable vector are left out.

    Unusable: null ids, null or empty vectors, null or non-finite components. Rows of one vec_id are
    one vector, the smallest in array order. Components are ints, or longs where the table needs them.
    """
    scaled = lambda c: c.cast("double") * F.lit(float(scale))
    finite = F.forall("embedding", lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    rows = embeddings.where("vec_id is not null and size(embedding) > 0").where(finite)
    top = rows.agg(F.max(F.array_max(F.transform("embedding", lambda c: F.abs(scaled(c)))))).first()[0]
    kind = "int" if (top or 0) < 2.0**30 else "long"
    rows = rows.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda c: F.floor(scaled(c)).cast(kind)).alias("v")
    )
    return rows.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))


def _matrix(lists: pa.ListScalar, dim: int) -> np.ndarray:
    return lists.values.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(tile, query ids, low ends of their intervals, candidate ids, scores, own positions)."""
    for batch in batches:
        for i in range(batch.num_rows):
            x = {name: batch.column(name)[i] for name in ("tile", "q_ids", "q_v", "low", "ids", "v", "dim")}
            dim = x["dim"].as_py()
            q_ids, low, ids = (x[c].values.to_numpy(zero_copy_only=False) for c in ("q_ids", "low", "ids"))
            q, c = _matrix(x["q_v"], dim), _matrix(x["v"], dim)
            if dim * float(np.abs(q).max()) * float(np.abs(c).max()) < SAFE:
                scores = (q.astype(float) @ c.T.astype(float)).astype(np.int64)
            else:
                scores = q.astype(np.int64) @ c.T.astype(np.int64)
            yield (dim, x["tile"].as_py()), q_ids, low, ids, scores, np.equal.outer(q_ids, ids)


def exact_top_k(
    embeddings: DataFrame, k: int = 20, every: int = 20, scale: int = 64, block_rows: int = 2048, query_rows: int = 512
) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of each query, exactly.

    Queries are the vectors whose vec_id is divisible by ``every``, candidates all other vectors of
    the same length. Both are gathered in blocks of bounded size; each block of queries meets each block
    of candidates once a round, dealt out by block and part. A round sums histograms of BINS bins
    over the open score interval of every query and keeps the bin with its k-th score, until
    intervals hold a single value. A last round returns what scores above that value, and of the ties at it
    the smallest ids of each tile, so neither ties nor copies make more than 2 k rows a tile. Ranks
    break ties by smaller vec_id. Vectors whose scores may not fit a long raise an error. For rows that take no part see ``whole_vectors``; an empty table
    gives no rows.
    """
    vectors = stored(whole_vectors(embeddings, scale))
    is_query = F.col("vec_id") % every == 0
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c))
    facts = vectors.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("q"), F.max(norm).alias("top"),
        F.max(F.when(is_query, norm)).alias("q_top"),
    ).first()
    bound = int((facts["top"] or 0) * (facts["q_top"] or 0) * 1.0001) + 2
    if bound > WIDEST:
        raise ValueError("inner products of these vectors may not fit a long")
    n_tiles, n_blocks = -(-facts["q"] // query_rows) or 1, -(-facts["n"] // block_rows) or 1

    dealt = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    blocks = vectors.groupBy("dim", dealt(n_blocks).alias("block")).agg(
        F.collect_list("vec_id").alias("ids"), F.collect_list("v").alias("v")
    )
    blocks = stored(blocks.withColumn("part", F.pmod("block", F.lit(PARTS))))
    state = vectors.where(is_query).select(
        F.col("vec_id").alias("query_id"), F.col("v").alias("q_v"), "dim", dealt(n_tiles).alias("tile"),
        F.lit(-bound).cast("long").alias("low"), F.lit(k).cast("long").alias("left"),
    )

    def meeting(state: DataFrame) -> DataFrame:
        q = state.groupBy("dim", "tile").agg(*[F.collect_list(c).alias(a) for c, a in (("query_id", "q_ids"), ("q_v", "q_v"), ("low", "low"))])
        q = q.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        return blocks.withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(n_tiles - 1)))).join(q, ["dim", "tile", "part"])

    def histograms(width: int, span: int):
        def counted(held):
            for q_ids, h in held.values():
                at, bins = np.nonzero(h)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[at]), pa.array(bins.astype(np.int32)), pa.array(h[at, bins])], names=["query_id", "bin", "n"])

        def run(batches):
            held: dict[tuple, tuple] = {}
            for tile, q_ids, low, _, scores, own in _tiles(batches):
                up = scores - low[:, None]
                bins = np.where((up >= 0) & (up < span) & ~own, up // width, BINS)
                n = len(q_ids)
                flat = np.bincount((bins + np.arange(n)[:, None] * (BINS + 1)).ravel(), minlength=n * (BINS + 1))
                # Blocks list their queries in any order: the order of the first one counts.
                order = np.argsort(q_ids)
                h = flat.reshape(n, BINS + 1)[order, :BINS]
                held[tile] = (q_ids[order], held[tile][1] + h if tile in held else h)
                if len(held) == HELD:
                    yield from counted(held)
                    held = {}
            yield from counted(held)

        return run

    span = 2 * bound + 1  # of the open intervals
    while span > 1:
        width = -(-span // BINS)
        bins = meeting(state).mapInArrow(histograms(width, span), "query_id long, bin int, n long")
        bins = bins.groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query_id").orderBy(F.desc("bin"))
        above = bins.withColumn("reached", F.sum("n").over(down)).join(state.select("query_id", "left"), "query_id")
        kth = above.where("reached >= left").groupBy("query_id").agg(F.max_by(F.struct("bin", (F.col("reached") - F.col("n")).alias("higher")), "bin").alias("at"))
        state = state.join(kth, "query_id", "left").select(
            "query_id", "q_v", "dim", "tile",
            F.when(F.col("at").isNull(), F.lit(NOWHERE)).otherwise(F.col("low") + F.col("at.bin").cast("long") * width).alias("low"),
            F.coalesce(F.col("left") - F.col("at.higher"), F.col("left")).alias("left"),
        )
        state, span = stored(state), width

    def best(batches):
        for _, q_ids, low, ids, scores, own in _tiles(batches):
            keep = (scores > low[:, None]) & ~own
            by_id = np.argsort(ids)
            tied = ((scores == low[:, None]) & ~own)[:, by_id]
            tied &= np.cumsum(tied, 1) <= k
            keep[:, by_id] |= tied
            at, to = np.nonzero(keep)
            yield pa.RecordBatch.from_arrays([pa.array(q_ids[at]), pa.array(ids[to]), pa.array(scores[at, to])], names=["query_id", "vec_id", "score"])

    found = meeting(state).mapInArrow(best, "query_id long, vec_id long, score long")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
