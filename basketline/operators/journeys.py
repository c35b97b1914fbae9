"""Sessions: milestones, funnels, time to purchase, inferred visits and example timelines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketline.functions.columns import of_type, ratio
from basketline.functions.ranking import nearest_rank

PAIR = ["user_id", "session_id", "product_id"]


def _at(kind: str, ts: str) -> Column:
    return F.when(of_type(kind), F.col(ts))


def journey_pairs(df: DataFrame, ts: str = "event_time") -> DataFrame:
    """Milestones of every (customer, session, product): first view, first cart, first and last purchase.

    Rows without an observed session are left out. Only minima and maxima are kept, so copies and
    very long sessions collapse before the exchange.
    """
    return (
        df.filter(F.col("session_id").isNotNull())
        .groupBy(*PAIR)
        .agg(
            F.min(_at("view", ts)).alias("first_view"),
            F.min(_at("cart", ts)).alias("first_cart"),
            F.min(_at("purchase", ts)).alias("first_purchase"),
            F.max(_at("purchase", ts)).alias("last_purchase"),
        )
    )


def view_to_purchase(df: DataFrame, ts: str = "event_time", pairs: DataFrame | None = None) -> DataFrame:
    """First purchase at or after the first view of the same product in the same session.

    The milestones settle every pair whose first purchase already follows the first view. Only pairs
    bought before *and* after the first view need more, see ``_purchase_after``.
    """
    pairs = journey_pairs(df, ts) if pairs is None else pairs
    matched = _complete(pairs).filter(F.col("last_purchase") >= F.col("first_view"))
    settled = matched.filter(F.col("first_purchase") >= F.col("first_view")).select(
        *PAIR, "first_view", "first_purchase"
    )
    unsettled = matched.filter(F.col("first_purchase") < F.col("first_view")).select(*PAIR, "first_view")
    found = settled.unionByName(_purchase_after(unsettled, df, ts))
    seconds = _epoch_seconds("first_purchase") - _epoch_seconds("first_view")
    return found.withColumn("seconds_to_purchase", seconds)


def _complete(df: DataFrame, *more: str) -> DataFrame:
    """Rows whose keys are all known, as the joins demand. Said once, and before the joins are planned,
    the filter is the same on every branch, so that each aggregate is computed once and reused."""
    for name in (*PAIR, *more):
        df = df.filter(F.col(name).isNotNull())
    return df


def _purchase_after(pairs: DataFrame, df: DataFrame, ts: str) -> DataFrame:
    """First purchase of each pair that is not before ``first_view``.

    Purchases are reduced to the first and last of every minute, so that an endless session brings
    one row per minute to its join. Minutes after the first view are settled by that; the single
    purchases are only looked up in the minute of the first view, by pair and minute.
    """
    bought = df.filter(of_type("purchase")).select(*PAIR, F.col(ts).alias("_bought"))
    bought = _complete(bought.withColumn("_minute", F.date_trunc("minute", "_bought")), "_bought", "_minute")
    minutes = bought.groupBy(*PAIR, "_minute").agg(
        F.min("_bought").alias("_first"), F.max("_bought").alias("_last")
    )
    after = minutes.join(pairs, PAIR).filter(F.col("_last") >= F.col("first_view"))
    whole = after.filter(F.col("_first") >= F.col("first_view")).select(
        *PAIR, "first_view", F.col("_first").alias("_bought")
    )
    divided = after.filter(F.col("_first") < F.col("first_view")).select(*PAIR, "_minute", "first_view")
    part = (
        bought.distinct()
        .join(divided, [*PAIR, "_minute"])
        .filter(F.col("_bought") >= F.col("first_view"))
        .select(*PAIR, "first_view", "_bought")
    )
    return whole.unionByName(part).groupBy(*PAIR, "first_view").agg(F.min("_bought").alias("first_purchase"))


def _epoch_seconds(column: str) -> Column:
    return F.unix_seconds(F.col(column).cast("timestamp"))


def time_to_purchase(timings: DataFrame) -> DataFrame:
    """Number of matched pairs and the exact median, by nearest rank, of the seconds between the two."""
    median = nearest_rank(timings.withColumn("_all", F.lit(0)), "_all", "seconds_to_purchase", [0.5])
    return median.agg(  # no pairs: one row still
        F.coalesce(F.max("n"), F.lit(0)).alias("matched_session_products"),
        F.max("percentile").alias("median_seconds_to_purchase"),
    )


def cart_funnel(
    df: DataFrame, keys: Sequence[str], ts: str, observed_only: bool = False
) -> DataFrame:
    """Sessions with a cart action, and those with a purchase at or after the first one.

    The snapshot report identifies a session by ``session_id`` alone and drops sessions the source
    did not observe (``observed_only``); the history report uses customer and session.
    """
    rows = df.filter(F.coalesce("session_observed", F.lit(True))) if observed_only else df
    if not observed_only:
        rows = rows.filter(F.col("session_id").isNotNull())
    return _converted(
        rows.groupBy(*keys).agg(
            F.min(_at("cart", ts)).alias("first_cart"), F.max(_at("purchase", ts)).alias("last_purchase")
        )
    )


def funnel_of_pairs(pairs: DataFrame) -> DataFrame:
    """The (customer, session) funnel from milestones that are at hand, without reading events again."""
    return _converted(
        pairs.groupBy("user_id", "session_id").agg(
            F.min("first_cart").alias("first_cart"), F.max("last_purchase").alias("last_purchase")
        )
    )


def _converted(sessions: DataFrame) -> DataFrame:
    return sessions.agg(
        F.count("first_cart").alias("cart_sessions"),
        F.count_if(F.col("last_purchase") >= F.col("first_cart")).alias("converted_sessions"),
    )


def with_funnel_rate(funnel: DataFrame) -> DataFrame:
    rate = ratio(F.col("converted_sessions"), F.col("cart_sessions"))
    return funnel.withColumn("conversion_rate", rate)


def inferred_sessions(
    df: DataFrame, ts: str = "event_time", gap_minutes: int = 30, key: str = "user_id"
) -> DataFrame:
    """Visits of a customer separated by more than ``gap_minutes`` of inactivity. Batch only.

    Two events in the same slice of one gap length can never be a break apart, so rows are first
    reduced to (customer, slice). That leaves at most one row per gap and customer to put in order,
    even for a customer with a third of all rows, and the result is the same as for single events.
    """
    gap = gap_minutes * 60_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    slices = df.groupBy(key, (micros - F.pmod(micros, F.lit(gap))).alias("_slice")).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_n")
    )
    in_order = Window.partitionBy(key).orderBy("_slice")
    quiet = F.unix_micros(F.col("_first").cast("timestamp")) - F.unix_micros(
        F.lag("_last").over(in_order).cast("timestamp")
    )
    visits = slices.withColumn("_break", F.coalesce((quiet > gap).cast("int"), F.lit(1))).withColumn(
        "_visit", F.sum("_break").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    return (
        visits.groupBy(key, "_visit")
        .agg(
            F.min("_first").alias("session_start"),
            F.max("_last").alias("last_action"),
            F.sum("_n").alias("actions"),
        )
        .drop("_visit")
    )


def inferred_session_count(sessions: DataFrame) -> DataFrame:
    return sessions.agg(F.count(F.lit(1)).alias("inferred_sessions"))


def session_timelines(
    df: DataFrame, sessions: int = 10, cap: int = 200, ts: str = "event_time", order: str = "source_row"
) -> DataFrame:
    """The first actions of the first sessions by customer and session id, one row per action.

    ``sessions`` and ``cap`` are the size of the report. ``total_actions`` counts the whole session
    and ``timeline_truncated`` says when it is longer than the timeline. The chosen sessions are a
    fixed small number of rows; the rank filter becomes a group limit below the exchange, so no task
    ever sends more than ``cap`` rows of a session.
    """
    keys = ["user_id", "session_id"]
    chosen = (
        df.filter(F.col("session_id").isNotNull())
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("total_actions"))
        .orderBy(*keys)
        .limit(sessions)
    )
    actions = df.select(*keys, ts, order, "event_type", "product_id", "category", "price_minor").join(
        F.broadcast(chosen) if sessions <= 10_000 else chosen, keys
    )
    in_session = Window.partitionBy(*keys).orderBy(ts, order)
    return (
        actions.withColumn("position", F.row_number().over(in_session))
        .filter(F.col("position") <= cap)
        .withColumn("timeline_truncated", F.col("total_actions") > cap)
    )


def nest_timelines(timelines: DataFrame, ts: str = "event_time") -> DataFrame:
    """One row per session with its (already capped) actions as an array in order."""
    entry = F.struct("position", ts, "event_type", "product_id", "category", "price_minor")
    nested = timelines.groupBy("user_id", "session_id", "total_actions", "timeline_truncated").agg(
        F.array_sort(F.collect_list(entry)).alias("timeline")
    )
    return nested.withColumn("timeline", F.transform("timeline", lambda e: e.dropFields("position")))
