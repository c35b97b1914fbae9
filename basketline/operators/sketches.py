"""Count-Min and Bloom sketches as small tables that aggregate, merge and join like any other.

The hash functions are slices of SHA-256 digests of ``<block>:<key>``, eight of 32 bits per digest, so a
sketch has at most 2**32 cells in a row. A sketch table is never larger than its fixed width
and depth, whatever it has seen. A Bloom filter is cut into buckets: the first slice of a key chooses its
bucket, the following ones its bits there, so that a probe meets one row of the filter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketline.functions.hashing import number

BROADCAST_CELLS = 1_000_000  # cells of a sketch that every task may hold
BUCKET_BITS = 32_768  # most bits of a bitmap
DIGITS = 8  # of a hash, in hexadecimal


def cms_shape(epsilon: float = 0.01, failure_probability: float = 0.01) -> tuple[int, int]:
    """(width, depth) for an overcount of at most epsilon·N with the given certainty."""
    if not 0 < epsilon < 1 or not 0 < failure_probability < 1:
        raise ValueError("probabilities must be between zero and one")
    return math.ceil(math.e / epsilon), math.ceil(math.log(1 / failure_probability))


def bloom_shape(capacity: int, false_positive_rate: float = 0.01) -> tuple[int, int]:
    """(bits, hashes) of a filter for ``capacity`` keys."""
    if capacity < 1 or not 0 < false_positive_rate < 1:
        raise ValueError("invalid capacity or probability")
    bits = math.ceil(-capacity * math.log(false_positive_rate) / math.log(2) ** 2)
    return bits, max(1, round(bits / capacity * math.log(2)))


def digests(key: str, hashes: int) -> Column:
    """The digests that hold so many slices of a key."""
    blocks = -(-hashes * DIGITS // 64)
    return F.array(*[F.sha2(F.concat(F.lit(f"{b}:"), F.col(key).cast("string")), 256) for b in range(blocks)])


def hashed(df: DataFrame, key: str, hashes: int, width: int) -> DataFrame:
    """One row per input row and hash function, with ``seed`` and ``cell`` in [0, width)."""
    if width > 16**DIGITS:
        raise ValueError(f"a sketch has at most {16**DIGITS} cells in a row")
    per_digest = 64 // DIGITS
    digest = F.get("_digests", F.floor(F.col("seed") / per_digest).cast("int"))
    slot = F.pmod("seed", F.lit(per_digest))
    return (
        df.withColumn("_digests", digests(key, hashes))
        .withColumn("seed", F.explode(F.sequence(F.lit(0), F.lit(hashes - 1))))
        .withColumn("cell", F.pmod(number(digest, slot, DIGITS), F.lit(width)))
        .drop("_digests")
    )


def _small(cells: DataFrame, bound: int) -> DataFrame:
    """Offer a sketch for broadcast only while its fixed size allows it."""
    return F.broadcast(cells) if bound <= BROADCAST_CELLS else cells


def cms_build(df: DataFrame, key: str, epsilon: float = 0.01, failure_probability: float = 0.01) -> DataFrame:
    """Count-Min table (seed, cell, hits): at most depth × width rows, and so many per task.

    Rows are added up per key first, so that a key is hashed once however often it occurs.
    """
    width, depth = cms_shape(epsilon, failure_probability)
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return hashed(counts, key, depth, width).groupBy("seed", "cell").agg(F.sum("_n").alias("hits"))


def cms_merge(*sketches: DataFrame) -> DataFrame:
    """Sketch of all the data that the given sketches of the same shape have seen."""
    merged = sketches[0]
    for other in sketches[1:]:
        merged = merged.unionByName(other)
    return merged.groupBy("seed", "cell").agg(F.sum("hits").alias("hits"))


def cms_total(sketch: DataFrame) -> DataFrame:
    """Number of rows seen: every row hits each seed once."""
    return sketch.filter(F.col("seed") == 0).agg(F.coalesce(F.sum("hits"), F.lit(0)).alias("total"))


def cms_estimate(
    sketch: DataFrame, keys: DataFrame, key: str, epsilon: float = 0.01, failure_probability: float = 0.01
) -> DataFrame:
    """Add ``estimate`` to the distinct ``keys``: never below the true count."""
    width, depth = cms_shape(epsilon, failure_probability)
    cells = hashed(keys, key, depth, width)
    looked_up = cells.join(_small(sketch, width * depth), ["seed", "cell"], "left")
    kept = [c for c in keys.columns if c != key]
    return looked_up.groupBy(key, *kept).agg(F.min(F.coalesce("hits", F.lit(0))).alias("estimate"))


def heavy_hitters(df: DataFrame, key: str, k: int = 20) -> DataFrame:
    """Exact counts of the k most frequent keys; the key breaks ties."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("exact")).orderBy(F.desc("exact"), key).limit(k)


def cms_comparison(df: DataFrame, key: str, k: int = 20, **shape: float) -> DataFrame:
    """Exact and estimated counts of the heavy hitters, and the overcount."""
    exact = heavy_hitters(df, key, k)
    return cms_estimate(cms_build(df, key, **shape), exact, key, **shape).withColumn(
        "overcount", F.col("estimate") - F.col("exact")
    )


def bloom_buckets(capacity: int, false_positive_rate: float = 0.01) -> tuple[int, int, int]:
    """(buckets, bits of a bucket, hashes) of a filter for ``capacity`` keys."""
    bits, hashes = bloom_shape(capacity, false_positive_rate)
    buckets = -(-bits // BUCKET_BITS)
    return buckets, -(-bits // buckets), hashes


def _slice(key: str, hashes: int, seed: int, width: int) -> Column:
    per_digest = 64 // DIGITS
    found = number(digests(key, hashes + 1)[seed // per_digest], F.lit(seed % per_digest), DIGITS)
    return F.pmod(found, F.lit(width))


def bloom_build(df: DataFrame, key: str, capacity: int, false_positive_rate: float = 0.01) -> DataFrame:
    """The filter as (bucket, bits): one bitmap per bucket; each task sets its bits before the exchange."""
    buckets, size, hashes = bloom_buckets(capacity, false_positive_rate)
    places = F.array(*[_slice(key, hashes, seed, size) for seed in range(1, hashes + 1)])
    rows = df.filter(F.col(key).isNotNull()).select(_slice(key, hashes, 0, buckets).alias("bucket"), F.explode(places).alias("_at"))
    # Places of the bitmap functions begin with 1.
    return rows.groupBy("bucket").agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("_at") + 1)).alias("bits"))


def bloom_merge(*filters: DataFrame) -> DataFrame:
    """Filter of all the keys that the given filters of the same shape have seen."""
    merged = filters[0]
    for other in filters[1:]:
        merged = merged.unionByName(other)
    return merged.groupBy("bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def bloom_contains(
    filter_bits: DataFrame, probes: DataFrame, key: str, capacity: int, false_positive_rate: float = 0.01
) -> DataFrame:
    """Every probe with ``maybe_present``: false means certainly never inserted, as for a NULL.

    A probe is one row of the join with the bitmap of its bucket; its bits are looked up there.
    """
    buckets, size, hashes = bloom_buckets(capacity, false_positive_rate)
    asked = probes.select(key, _slice(key, hashes, 0, buckets).alias("bucket"))
    present = F.lit(True)
    for seed in range(1, hashes + 1):
        at = _slice(key, hashes, seed, size)
        byte = F.substring("bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))
        present = present & (F.getbit(F.conv(F.hex(byte), 16, 10).cast("bigint"), (at % 8).cast("int")) == 1)
    found = asked.join(_small(filter_bits, buckets * size), "bucket", "left")
    return found.select(key, F.coalesce(present, F.lit(False)).alias("maybe_present"))


def bloom_report(answers: DataFrame) -> DataFrame:
    """False positives among probes that are known to be absent."""
    return answers.agg(
        F.count(F.lit(1)).alias("absent_probes"),
        F.count_if("maybe_present").alias("false_positives"),
    ).withColumn(
        "observed_false_positive_pct",
        F.try_divide(F.lit(100.0) * F.col("false_positives"), F.col("absent_probes").cast("double")),
    )
