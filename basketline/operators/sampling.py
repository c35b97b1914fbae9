"""Stable samples and the totals estimated from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketline import constants as C
from basketline.functions.columns import purchase_value, ratio, total
from basketline.functions.hashing import id_bucket, in_hash_sample, seeded_rank


def hash_sample(df: DataFrame, fraction: float, key: str = "event_id") -> DataFrame:
    """Rows whose id falls into the sample; rerunning gives the same rows."""
    return df.filter(in_hash_sample(F.col(key), fraction))


def sample_estimate(df: DataFrame, fractions: Sequence[float] = C.SAMPLE_FRACTIONS) -> DataFrame:
    """Events and purchase revenue scaled up from a hash sample, one row per fraction. Batch only.

    ``df`` holds every event once. All fractions and the exact totals come from one scan into one
    row of conditional sums, which is then turned into one row per fraction.
    """
    for fraction in fractions:
        if not 0 < fraction <= 1:
            raise ValueError("sample fraction must be in (0, 1]")
    rows = df.select(id_bucket(F.col("event_id")).alias("_bucket"), purchase_value().alias("_value"))
    measures = [F.count(F.lit(1)).alias("exact_events"), total("_value").alias("exact_revenue_paise")]
    for i, fraction in enumerate(fractions):
        member = F.col("_bucket") < F.lit(float(fraction) * 2**32)
        measures.append(F.count_if(member).alias(f"_count{i}"))
        measures.append(total(F.when(member, F.col("_value"))).alias(f"_value{i}"))
    entries = [
        F.struct(
            F.lit(float(fraction)).alias("fraction"),
            F.col(f"_count{i}").alias("sample_count"),
            F.col(f"_value{i}").alias("sample_revenue_paise"),
        )
        for i, fraction in enumerate(fractions)
    ]
    wide = rows.agg(*measures)
    return wide.select("exact_events", "exact_revenue_paise", F.explode(F.array(*entries)).alias("s")).select(
        "s.*",
        (F.col("s.sample_count") / F.col("s.fraction")).alias("estimated_events"),
        (F.col("s.sample_revenue_paise") / F.col("s.fraction")).alias("estimated_revenue_paise"),
        "exact_events",
        "exact_revenue_paise",
    )


def with_sampling_error(estimates: DataFrame) -> DataFrame:
    """Signed relative error of every estimate; NULL when the exact total is zero."""

    def error(estimate: str, exact: str):
        return ratio(F.col(estimate) - F.col(exact), F.col(exact))

    return estimates.withColumn(
        "event_relative_error", error("estimated_events", "exact_events")
    ).withColumn("revenue_relative_error", error("estimated_revenue_paise", "exact_revenue_paise"))


def uniform_sample(
    df: DataFrame, size: int = 1000, seed: int = C.SAMPLE_SEED, key: str = "event_id"
) -> DataFrame:
    """Uniform sample without replacement: the ``size`` rows first in a seeded random order of ids.

    Keeping the smallest is mergeable, so every task reports at most ``size`` rows and the outcome
    does not depend on the partitioning.
    """
    if size < 1:
        raise ValueError("size must be positive")
    return df.withColumn("_rank", seeded_rank(F.col(key), seed)).orderBy("_rank", key).limit(size).drop("_rank")
