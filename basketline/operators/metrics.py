"""Window metrics and totals of live events, shared by batch and streaming."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketline import constants as C
from basketline.functions.columns import of_type, purchase_value, ratio, total

WINDOW_KEYS = list(C.METRIC_KEYS)
EXACT_USERS = "active_users_exact"
# Registers of a sketch of users, as a power of two: a merged one has an error of 1.04 / sqrt(registers).
SKETCH_BITS = math.ceil(2 * math.log2(1.04 / C.DISTINCT_RSD))


def _counters() -> list[Column]:
    return [
        F.count("event_id").alias("events"),
        F.count_if(of_type("purchase")).alias("purchases"),
        F.sum(purchase_value()).alias("revenue_paise"),
        F.count_if(of_type("view")).alias("views"),
        F.count_if(of_type("cart")).alias("carts"),
    ]


def _merged() -> list[Column]:
    return [F.sum(name).alias(name) for name in C.EXACT_MEASURES]


def _seconds(duration: str) -> int:
    """Length of a fixed duration text such as ``5 minutes``."""
    units = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    amount, unit = duration.split()
    return int(amount) * units[unit.rstrip("s")]


def _flat(grouped: DataFrame) -> DataFrame:
    rest = [c for c in grouped.columns if c != "window"]
    return grouped.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *rest
    )


def window_metrics(
    df: DataFrame, size: str = "1 minute", slide: str | None = None, users: str | None = "approx"
) -> DataFrame:
    """Per (window, category, product): events, purchases, revenue, views, carts and users.

    ``users`` is ``approx`` (mergeable estimate, also for streams), ``exact`` (batch only) or None.

    A sliding batch first adds up every slide on its own and copies those few rows into the windows
    that contain them; estimated users go along as sketches that are merged, exact ones as one row per
    user and slide, so neither copies raw events.
    """
    slide = slide or size
    sliding = size != slide
    if df.isStreaming or (users == "approx" and not sliding):
        if users == "exact":
            raise ValueError("exact users per window are a batch measure")
        estimate = [F.approx_count_distinct("user_id", C.DISTINCT_RSD).alias(C.APPROX_MEASURE)]
        return _flat(
            df.groupBy(F.window("event_ts", size, slide), "category", "product_id").agg(
                *_counters(), *(estimate if users else [])
            )
        )
    if _seconds(size) % _seconds(slide):
        raise ValueError("the window size must be a multiple of the slide")
    approx = users == "approx"
    carried = ["category", "product_id"] + (["user_id"] if users == "exact" else [])
    sketch = [F.hll_sketch_agg("user_id", SKETCH_BITS).alias(USERS_SKETCH)] if approx else []
    pieces = df.groupBy(F.window("event_ts", slide), *carried).agg(*_counters(), *sketch)
    if sliding:
        pieces = pieces.withColumn("_at", F.col("window.start")).drop("window")
        merged = [F.hll_sketch_estimate(F.hll_union_agg(USERS_SKETCH)).alias(C.APPROX_MEASURE)] if approx else []
        pieces = pieces.groupBy(F.window("_at", size, slide), *carried).agg(*_merged(), *merged)
    if users == "exact":
        pieces = pieces.groupBy("window", "category", "product_id").agg(
            *_merged(), F.count("user_id").alias(EXACT_USERS)
        )
    return _flat(pieces)


USERS_SKETCH = "users_sketch"


def user_sketches(df: DataFrame, by: Sequence[str], slide: str = "1 minute", ts: str = "event_ts") -> DataFrame:
    """A sketch of the users of every slide and key: a table of fixed-size rows that merges to any coarser grain."""
    grouped = df.groupBy(F.window(ts, slide).alias("_slide"), *by)
    return grouped.agg(F.hll_sketch_agg("user_id", SKETCH_BITS).alias(USERS_SKETCH)).select(
        F.col("_slide.start").alias("slide_start"), *by, USERS_SKETCH
    )


def merge_users(sketches: DataFrame, by: Sequence[str | Column] = ()) -> DataFrame:
    """Estimated distinct users at a coarser grain, from ``user_sketches``: users seen twice count once."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg(USERS_SKETCH)).alias(C.APPROX_MEASURE))


def snapshot_totals(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Events, purchases, revenue, exact and estimated users: one row, or one for each value of ``by``. Batch only.

    Rows are added up per user first: the exact count is then a plain count, and the estimate sees
    every user once, which gives the same registers as seeing every event.
    """
    per_user = df.groupBy(*by, "user_id").agg(
        F.count(F.lit(1)).alias("events"),
        F.count_if(of_type("purchase")).alias("purchases"),
        F.sum(purchase_value()).alias("revenue_paise"),
    )
    return per_user.groupBy(*by).agg(
        total("events").alias("events"),
        total("purchases").alias("purchases"),
        total("revenue_paise").alias("revenue_paise"),
        F.count("user_id").alias("active_users_exact"),
        F.approx_count_distinct("user_id", C.DISTINCT_RSD).alias("active_users_approx"),
    )


def estimate_in_bound(exact: str, estimate: str, errors: float = 4.0) -> Column:
    """Whether an estimated count is within so many standard errors of the exact one, or one off."""
    allowed = F.greatest(F.lit(1.0), F.lit(errors * C.DISTINCT_RSD) * F.col(exact))
    return F.abs(F.col(estimate) - F.col(exact)) <= allowed


def with_estimate_error(df: DataFrame, exact: str, estimate: str, name: str = "observed_error") -> DataFrame:
    """Relative distance of an estimated count from the exact one."""
    return df.withColumn(name, ratio(F.abs(F.col(estimate) - F.col(exact)), F.col(exact)))


def window_rollup(metrics: DataFrame) -> DataFrame:
    """Grand totals of tumbling rows. Users are left out: they do not add up across windows."""
    return metrics.agg(*[total(name).alias(name) for name in C.EXACT_MEASURES])


def in_period(metrics: DataFrame, minutes: int | None, as_of: datetime | Column | str) -> DataFrame:
    """Windows that start within the last ``minutes`` before the current minute; None keeps all."""
    if minutes is None:
        return metrics
    now = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp")
    floor = F.date_trunc("minute", now) - F.make_dt_interval(mins=F.lit(minutes))
    return metrics.filter(F.col("window_start") >= floor)


def from_source(df: DataFrame, namespace: str, real: bool, column: str = "product_id") -> DataFrame:
    """Only the rows of the namespaced source, or only the others. Never both together."""
    tagged = F.col(column).startswith(namespace)
    return df.filter(tagged if real else ~tagged)


def analysis_clock(df: DataFrame, real: bool) -> DataFrame:
    """``analysis_ts``: the original time of replayed events, the event clock otherwise."""
    clock = F.try_to_timestamp("source_event_time") if real else F.col("event_ts")
    return df.withColumn("analysis_ts", clock)


def period_totals(
    metrics: DataFrame, minutes: int | None, as_of, namespace: str | None = None, real: bool = False
) -> DataFrame:
    """Totals of a source over the last minutes; non-overlapping windows only."""
    rows = metrics if namespace is None else from_source(metrics, namespace, real)
    return window_rollup(in_period(rows, minutes, as_of))


def period_totals_each(
    metrics: DataFrame, periods: dict[str, int | None], namespace: str, real: bool = False
) -> DataFrame:
    """``period_totals`` of several periods, one row each, in one pass over the metrics.

    The clock is the newest window of all sources. Metrics are first added up by minute, so the second
    pass, which needs the clock, reads one row per minute.
    """
    tagged = F.col("product_id").startswith(namespace)
    wanted = tagged if real else ~tagged
    minutes = metrics.groupBy("window_start").agg(
        *[F.sum(F.when(wanted, F.col(name)).otherwise(F.lit(0))).alias(name) for name in C.EXACT_MEASURES]
    )
    now = minutes.agg(F.max("window_start").alias("at")).scalar()
    sums = []
    for number, length in enumerate(periods.values()):
        inside = F.lit(True) if length is None else F.col("window_start") >= now - F.make_dt_interval(mins=F.lit(length))
        sums += [
            F.coalesce(F.sum(F.when(inside, F.col(name))), F.lit(0)).cast("bigint").alias(f"{name}_{number}")
            for name in C.EXACT_MEASURES
        ]
    rows = F.array(
        *[
            F.struct(F.lit(label).alias("period"), *[F.col(f"{name}_{number}").alias(name) for name in C.EXACT_MEASURES])
            for number, label in enumerate(periods)
        ]
    )
    return minutes.agg(*sums).select(F.inline(rows))


def action_mix(totals: DataFrame) -> DataFrame:
    """One row per kind of action, with everything else as ``Other actions``."""
    other = "events - views - carts - purchases"
    return totals.selectExpr(
        "stack(4, 'Viewed a product', views, 'Added to cart', carts, 'Purchased', purchases, "
        f"'Other actions', {other}) AS (action, count)"
    )


def avg_purchase_value(totals: DataFrame) -> DataFrame:
    """Listed value per purchase record in major units; NULL without purchases."""
    return totals.select(
        (F.col("revenue_paise") / F.lit(100.0)).cast("double").alias("purchase_value"),
        ratio(F.col("revenue_paise"), F.col("purchases") * 100).alias("avg_purchase_value"),
    )


def top_by(metrics: DataFrame, metric: str = "views", grain: str = "product_id", k: int = 10) -> DataFrame:
    """The k products or categories with the largest total; the key breaks ties."""
    if metric not in C.EXACT_MEASURES or grain not in ("product_id", "category"):
        raise ValueError("rank products or categories by an exact measure")
    return (
        metrics.groupBy(grain).agg(F.sum(metric).alias(metric)).orderBy(F.desc(metric), grain).limit(k)
    )


def top_by_each(
    metrics: DataFrame, names: Sequence[str], grain: str = "product_id", k: int = 10
) -> DataFrame:
    """(metric, key, value) of the k largest totals of each metric, in one pass; the key breaks ties."""
    totals = metrics.groupBy(F.col(grain).alias("key")).agg(*[F.sum(n).alias(n) for n in names])
    pairs = ", ".join(f"'{n}', {n}" for n in names)
    long = totals.selectExpr("key", f"stack({len(names)}, {pairs}) AS (metric, value)")
    order = Window.partitionBy("metric").orderBy(F.desc("value"), "key")
    ranked = long.withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") <= k).select("metric", "key", "value")


def trending(sliding: DataFrame, k: int = 10, namespace: str | None = None, real: bool = False) -> DataFrame:
    """The k products with most views in the newest sliding window, of one source if its namespace is given.

    The newest window is that of the source, so a source that has paused still shows its last one.
    """
    if namespace is not None:
        sliding = from_source(sliding, namespace, real)
    newest = sliding.agg(F.max("window_start").alias("at")).scalar()
    return (
        sliding.filter(F.col("window_start") == newest)
        .orderBy(F.desc("views"), "product_id", "category")
        .limit(k)
        .select("product_id", "views", "purchases", "window_start", "window_end")
    )
