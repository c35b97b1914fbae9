"""Positions and running totals over an order too large for one task.

A window without a partition, or over one huge group, runs in a single task. Here the order is cut
into slices, each slice is numbered on its own, and the number of rows in the earlier slices is
added. Results are exact for every way of slicing that follows the order.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dense_position(
    df: DataFrame, order: str, slice_rows: int = 1_000_000, name: str = "position"
) -> DataFrame:
    """Number the rows 1, 2, 3, … by a unique non-negative integer column.

    A slice covers ``slice_rows`` values of the order and so holds at most that many rows. The table
    of slice sizes has one row per slice and is the only thing put in a global order.
    """
    sliced = df.withColumn("_slice", F.col(order) - F.pmod(order, F.lit(slice_rows)))
    sizes = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_slice", F.coalesce(before, F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_slice").orderBy(order))
    return (
        sliced.withColumn("_within", within)
        .join(starts, "_slice")
        .withColumn(name, (F.col("_before") + F.col("_within")).cast("bigint"))
        .drop("_slice", "_before", "_within")
    )


STEP = 16  # cut points per coarse cut


def _below(cuts: Column | str, value: str) -> Column:
    """How many of the cut points lie below the value."""
    return F.size(F.filter(cuts, lambda cut: cut < F.col(value)))


def nearest_rank(
    df: DataFrame, group: str | Sequence[str], value: str, probabilities: Sequence[float], slices: int = 256
) -> DataFrame:
    """Nearest-rank percentiles of ``value`` per group: the ceil(n·p)-th smallest, at least the first.

    Equal values are counted together first. The counted values are then sliced at their approximate
    quantiles, which split a group that dominates them evenly; sums over slices and sums within one
    slice give exact ranks wherever the cuts happen to fall.
    """
    keys = [group] if isinstance(group, str) else list(group)
    known = df.filter(F.col(value).isNotNull())
    quantiles = F.percentile_approx(value, [i / slices for i in range(1, slices)], 10_000)
    counts = known.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    # The filter, true for every row, keeps the counts in this branch too: both then share an exchange.
    cuts = counts.filter("_n > 0").agg(F.array_distinct(quantiles).alias("fine")).select(
        F.struct("fine", F.filter("fine", lambda _, i: i % STEP == STEP - 1).alias("coarse")).alias("cuts")
    )
    sliced = (
        counts.withColumn("_cuts", cuts.scalar())
        .withColumn("_near", _below("_cuts.coarse", value) * STEP)
        .withColumn("_slice", F.col("_near") + _below(F.slice("_cuts.fine", F.col("_near") + 1, STEP), value))
        .drop("_near", "_cuts")
    )
    sizes = sliced.groupBy(*keys, "_slice").agg(F.sum("_n").alias("_size"))
    by_slice = Window.partitionBy(*keys).orderBy("_slice")
    sizes = sizes.select(
        *[F.col(k).alias(f"_of_{k}") for k in [*keys, "_slice"]],
        F.coalesce(F.sum("_size").over(by_slice.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(
            "_before"
        ),
        F.sum("_size").over(Window.partitionBy(*keys)).alias("n"),
    )
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in probabilities]))
    running = F.sum("_n").over(
        Window.partitionBy(*keys, "_slice").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    )
    ranked = (
        sliced.withColumn("_running", running)
        .join(sizes, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in [*keys, "_slice"]]))
        .withColumn("_upto", F.col("_before") + F.col("_running"))
    )
    rank = F.greatest(F.ceil(F.col("n") * F.col("probability")), F.lit(1))
    return (
        ranked.withColumn("probability", wanted)
        .filter((rank <= F.col("_upto")) & (rank > F.col("_upto") - F.col("_n")))
        .select(*keys, "probability", "n", F.col(value).alias("percentile"))
    )

