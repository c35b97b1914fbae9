"""Period activity of customers and interest in products, from history events.

``df`` needs event_type, user_id, product_id, category, price_minor and a period column. Distinct
customers are always counted by adding up per customer first: one shuffle of partial sums per
level instead of an expansion of every event for every distinct measure, and a customer or product
with a huge share of the rows shrinks to one row per task before the exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketline import constants as C
from basketline.functions.columns import of_type, percent, total


def with_month(df: DataFrame, ts: str = "event_time", name: str = "period") -> DataFrame:
    return df.withColumn(name, F.date_format(ts, "yyyy-MM"))


def union_months(frames: list[DataFrame]) -> DataFrame:
    """All months as one frame; columns are matched by name and may be missing in some."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _marked(kind: str, value: Column | None = None) -> Column:
    return F.sum(F.when(of_type(kind), F.lit(1) if value is None else value).otherwise(F.lit(0)))


def customer_periods(df: DataFrame, period: str = "period") -> DataFrame:
    """Activity of every customer in every period, with the value of the purchase records."""
    return df.groupBy("user_id", period).agg(
        F.count(F.lit(1)).alias("actions"),
        F.count_if(of_type("view")).alias("views"),
        F.count_if(of_type("cart")).alias("carts"),
        F.count_if(of_type("purchase")).alias("purchases"),
        _marked("purchase", F.col("price_minor")).cast("bigint").alias("purchase_minor"),
    )


def first_observed(periods: DataFrame, period: str = "period") -> DataFrame:
    """First period in which each customer was seen."""
    # A text minimum sorts its input. The filter, true for every row, keeps the planner from merging
    # this level with the one below and so from sorting raw events instead of customer periods.
    seen = periods.filter(F.col("actions") > 0)
    return seen.groupBy("user_id").agg(F.min(period).alias("first_observed"))


def with_first_observed(periods: DataFrame, period: str = "period") -> DataFrame:
    """Add ``first_observed`` to every customer period.

    The frame has at most one row per customer and period, so the window over a customer is
    bounded by the number of periods however active the customer is.
    """
    first = F.min(period).over(Window.partitionBy("user_id"))
    return periods.withColumn("first_observed", first)


def period_summary(periods: DataFrame, period: str = "period", estimate: bool = True) -> DataFrame:
    """Per period: actions, customers (exact and estimated), actions by kind, purchase price sum."""
    measures = [F.sum("actions").alias("actions"), F.count("user_id").alias("customers")]
    if estimate:
        measures.append(F.approx_count_distinct("user_id", C.DISTINCT_RSD).alias("estimated_customers"))
    measures += [F.sum(name).alias(name) for name in ("views", "carts", "purchases")]
    measures.append((F.sum("purchase_minor") / F.lit(100.0)).cast("double").alias("purchase_price_sum"))
    return periods.groupBy(period).agg(*measures).orderBy(period)


def customer_behaviour(periods: DataFrame, period: str = "period") -> DataFrame:
    """Per period: active, returning, viewing, carting and purchasing customers."""
    known = with_first_observed(periods, period)
    return (
        known.groupBy(period)
        .agg(
            F.count(F.lit(1)).alias("active_customers"),
            F.count_if(F.col(period) > F.col("first_observed")).alias("returning_customers"),
            F.count_if(F.col("views") > 0).alias("viewers"),
            F.count_if(F.col("carts") > 0).alias("cart_users"),
            F.count_if(F.col("purchases") > 0).alias("purchasers"),
            F.count_if(F.col("purchases") > 1).alias("multiple_purchase_record_customers"),
        )
        .orderBy(period)
    )


def history_overview(summary: DataFrame) -> DataFrame:
    """All periods together. Counts and price sums add; distinct customers do not, so they are left out."""
    return summary.agg(
        total("actions").alias("events"),
        total("views").alias("views"),
        total("carts").alias("carts"),
        total("purchases").alias("purchases"),
        total(F.round(F.col("purchase_price_sum") * 100).cast("bigint")).alias("revenue_paise"),
    )


def category_interest(df: DataFrame, k: int = 20) -> DataFrame:
    """The k categories with most views, and their distinct viewers."""
    per_viewer = (
        df.filter(of_type("view")).groupBy("category", "user_id").agg(F.count(F.lit(1)).alias("views"))
    )
    return (
        per_viewer.groupBy("category")
        .agg(F.sum("views").alias("views"), F.count("user_id").alias("viewers"))
        .orderBy(F.desc("views"), "category")
        .limit(k)
    )


def product_totals(df: DataFrame) -> DataFrame:
    """Per product: category, distinct viewers and purchasers, views and purchases.

    The largest category is taken from the few (product, category) pairs, kept apart from the merging
    of aggregates by a filter that is true for all of them: a text maximum over events, or beside the
    counts, would make the planner sort all rows instead of hashing them.
    """
    known = F.col("user_id").isNotNull()
    per_customer = df.groupBy("product_id", "user_id").agg(
        F.count_if(of_type("view")).alias("views"), F.count_if(of_type("purchase")).alias("purchases")
    )
    counts = per_customer.groupBy("product_id").agg(
        F.count_if((F.col("views") > 0) & known).alias("viewers"),
        F.count_if((F.col("purchases") > 0) & known).alias("purchasers"),
        F.sum("views").alias("views"),
        F.sum("purchases").alias("purchases"),
    )
    named = df.groupBy("product_id", "category").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 0")
    categories = named.groupBy("product_id").agg(F.max("category").alias("category"))
    return categories.join(counts, "product_id")


def matched_buyers(pairs: DataFrame) -> DataFrame:
    """Per product: customers with a purchase at or after a view of it in the same session."""
    followed = F.coalesce(F.col("last_purchase") >= F.col("first_view"), F.lit(False))
    per_customer = pairs.groupBy("product_id", "user_id").agg(F.max(followed).alias("matched"))
    return per_customer.groupBy("product_id").agg(F.count_if("matched").alias("matched_buyers"))


def product_performance(totals: DataFrame, buyers: DataFrame) -> DataFrame:
    """Product totals with matched buyers and the observed conversion of viewers, in percent."""
    return (
        totals.join(buyers, "product_id", "left")
        .withColumn("matched_buyers", F.coalesce("matched_buyers", F.lit(0)))
        .withColumn("observed_conversion_pct", percent(F.col("matched_buyers"), F.col("viewers")))
    )


def top_products(products: DataFrame, k: int = 100) -> DataFrame:
    return products.orderBy(F.desc("views"), "product_id").limit(k)


def rank_products(products: DataFrame, by: str = "views") -> DataFrame:
    """Order a bounded product table by one of its measures, unknown values last."""
    if by not in ("views", "viewers", "purchasers", "observed_conversion_pct"):
        raise ValueError(f"cannot rank products by {by}")
    return products.orderBy(F.desc_nulls_last(by), "product_id")


def event_profile(df: DataFrame, ts: str = "event_time") -> DataFrame:
    """Rows, first and last time by event type."""
    return df.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(ts).alias("first_event_time"),
        F.max(ts).alias("last_event_time"),
    )
