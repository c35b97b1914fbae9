"""Agreement of two metric tables, and of stored rows with their manifests."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketline import constants as C


def reconcile(
    expected: DataFrame,
    actual: DataFrame,
    keys: Sequence[str] = C.METRIC_KEYS,
    fields: Sequence[str] = C.EXACT_MEASURES,
) -> DataFrame:
    """Rows on which the two tables differ: keys, both sets of fields, and which side lacks the key.

    Both sides have one row per key, so the full outer join has no hot keys. NULLs compare as equal,
    in keys and in fields.
    """
    left = expected.select(*[F.col(k).alias(f"_l_{k}") for k in keys], F.struct(*fields).alias("_expected"))
    right = actual.select(*[F.col(k).alias(f"_r_{k}") for k in keys], F.struct(*fields).alias("_actual"))
    same = reduce(and_, [F.col(f"_l_{k}").eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    both = left.join(right, same, "full_outer").select(
        *[F.coalesce(f"_l_{k}", f"_r_{k}").alias(k) for k in keys], "_expected", "_actual"
    )
    status = (
        F.when(F.col("_actual").isNull(), "missing")
        .when(F.col("_expected").isNull(), "unexpected")
        .otherwise("different")
    )
    return both.filter(~F.col("_expected").eqNullSafe(F.col("_actual"))).select(
        *keys,
        status.alias("status"),
        *[F.col(f"_expected.{f}").alias(f"expected_{f}") for f in fields],
        *[F.col(f"_actual.{f}").alias(f"actual_{f}") for f in fields],
    )


class CountMismatch(RuntimeError):
    """Stored rows differ from the rows their manifests promise."""


def count_guard(events: DataFrame, manifests: DataFrame) -> DataFrame:
    """One row: rows the manifests promise, rows found, and whether they agree."""
    promised = manifests.agg(F.coalesce(F.sum("accepted_rows"), F.lit(0)).cast("bigint").alias("n")).scalar()
    return (
        events.agg(F.count(F.lit(1)).alias("actual_rows"))
        .select(promised.alias("expected_rows"), "actual_rows")
        .withColumn("matched", F.col("expected_rows") == F.col("actual_rows"))
    )


def require_counts(events: DataFrame, manifests: DataFrame) -> int:
    row = count_guard(events, manifests).first()
    if not row["matched"]:
        raise CountMismatch(f"stored rows {row['actual_rows']} != manifest rows {row['expected_rows']}")
    return row["actual_rows"]
