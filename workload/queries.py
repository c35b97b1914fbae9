"""One query per operator over the driver tables, each over the whole tables."""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketline import constants as C
from basketline import schemas
from basketline.functions import ranking
from basketline.functions.columns import history_timestamp, purchase_value
from basketline.operators import contract, customers, dedup, journeys, metrics, normalize, quantiles, reports, sampling, sketches
from basketline.operators import reconcile as agreement
from basketline.plans.customers import run_customer_report
from basketline.plans.fixture import run_fixture_report
from basketline.plans.replay import positioned_replay
from basketline.plans.snapshot import run_snapshot
from basketline.session import pin_runtime, shared_folder, through_table
from basketline.sinks.changelog import committed_only, latest_by_epoch, latest_metrics
from basketline.sinks.history import import_month, republish_dates, write_by_customer, write_by_date
from basketline.sources.history import read_history_csv, read_manifests, read_months
from basketline.sources.raw import read_json_lines, scan_silver, stream_files
from basketline.sources.rows import path_prefix
from basketline.streaming import progress as health
from basketline.streaming.pipeline import Pipeline
from basketline.streaming.state import remembered_ids
from workload import views as V

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register a query under its name; instants leave as plain UTC timestamps."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        frame = build(pin_runtime(spark), sf_dir)
        return frame.select(
            *[
                F.col(f.name).cast("timestamp_ntz").alias(f.name)
                if isinstance(f.dataType, T.TimestampType)
                else F.col(f.name)
                for f in frame.schema.fields
            ]
        )

    QUERIES[build.__name__] = run
    return run


# --- sources and stored payloads --------------------------------------------------------


@query
def scan_events(spark, sf):
    return V.table(spark, sf, "events")


@query
def count_guard(spark, sf):
    events = V.silver(spark, sf)
    manifests = events.groupBy("period").agg(F.count(F.lit(1)).alias("accepted_rows"))
    return agreement.count_guard(events.filter("period <> 'w1'"), manifests)  # one period is short


@query
def prefix_sample(spark, sf):
    prefix = normalize.source_prefix(V.csv_rows(spark, sf), 500)
    return customers.event_profile(prefix.withColumn("event_time", history_timestamp(F.col("event_time"))))


def _sourced(spark, sf):
    events = V.mixed(spark, sf)
    real = F.when(F.col("product_id").startswith(V.NAMESPACE), "real")
    return V.as_raw(events, data_source=real)


@query
def json_path(spark, sf):
    source = F.coalesce(F.get_json_object("raw_json", "$.data_source"), F.lit("synthetic"))
    kind = F.get_json_object("raw_json", "$.event_type")
    return (
        _sourced(spark, sf)
        .groupBy(source.alias("data_source"), kind.alias("event_type"))
        .agg(F.count(F.lit(1)).alias("records"))
    )


@query
def recent_events(spark, sf):
    shown = reports.recent_events(_sourced(spark, sf), "real")
    product = F.get_json_object("raw_json", "$.product_id").alias("product_id")
    return shown.select("topic", "partition", "offset", "ingested_at", product)


# --- contract ---------------------------------------------------------------------------

EVENT_OUT = [
    "event_id",
    "user_id",
    "session_id",
    "event_type",
    "product_id",
    "product_name",
    "category",
    "quantity",
    "price_paise",
    "source_row",
    "event_ts",
]


@query
def parse_events(spark, sf):
    return contract.parse_events(V.raw(spark, sf)).select(
        "schema_version", *EVENT_OUT, "valid", "topic", "partition", "offset", "ingested_at"
    )


@query
def validate_events(spark, sf):
    return contract.parse_events(V.raw_bad(spark, sf)).select("offset", "valid")


@query
def silver_valid(spark, sf):
    silver, _ = contract.split_valid(contract.parse_events(V.raw_bad(spark, sf)))
    return silver.select(*EVENT_OUT)


@query
def quarantine(spark, sf):
    _, refused = contract.split_valid(contract.parse_events(V.raw_bad(spark, sf)))
    return refused.select("topic", "partition", "offset", "ingested_at")


@query
def reject_reasons(spark, sf):
    parsed = contract.parse_events(V.raw_bad(spark, sf), reasons=True)
    return contract.quarantined(parsed).select("offset", "reject_reason")


# --- history and replay -----------------------------------------------------------------


def _routed(spark, sf):
    return normalize.route_history(V.csv_rows(spark, sf), V.MONTH, V.ID_PREFIX)


@query
def history_normalize(spark, sf):
    return normalize.accepted_history(_routed(spark, sf))


@query
def history_rejects(spark, sf):
    return normalize.rejects(_routed(spark, sf)).select(
        "source_row", "reason", F.col("record.price").alias("price")
    )


@query
def import_manifest(spark, sf):
    return normalize.import_manifest(_routed(spark, sf))


@query
def replay_normalize(spark, sf):
    accepted, _ = normalize.normalize_replay(V.csv_rows(spark, sf), V.NAMESPACE, V.ID_PREFIX)
    return accepted


@query
def replay_slice(spark, sf):
    table = positioned_replay(V.csv_rows(spark, sf), V.NAMESPACE, V.ID_PREFIX)
    piece = normalize.replay_slice(table, 100, 500, run_id=1, at="2024-02-01T00:00:00+00:00")
    return piece.select("position", "event_id", "session_id", "event_time", "source_event_time", "source_row")


@query
def union_by_name(spark, sf):
    events = V.history(spark, sf)
    months = [
        events.filter(F.col("period") == f"w{i}").select(
            *(["event_type", "category", "event_id"] if i % 2 else ["event_id", "event_type"])
        )
        for i in range(5)
    ]
    return customers.union_months(months)


@query
def event_type_profile(spark, sf):
    return customers.event_profile(V.history(spark, sf))


# --- duplicates -------------------------------------------------------------------------


@query
def dedup_exact(spark, sf):
    accepted = contract.valid_events(contract.parse_events(V.raw_dup(spark, sf)))
    return dedup.dedup_exact(accepted).select("event_id", "offset", "event_type", "product_id", "price_paise")


@query
def conflicting_ids(spark, sf):
    return dedup.conflicting_ids(contract.parse_events(V.raw_conflict(spark, sf)).filter("valid"))


# --- live metrics -----------------------------------------------------------------------


@query
def window_tumbling(spark, sf):
    return V.tumbling(spark, sf)


@query
def window_sliding(spark, sf):
    return V.sliding(spark, sf)


@query
def window_exact_users(spark, sf):
    return metrics.window_metrics(V.silver(spark, sf), users="exact")


@query
def window_sliding_exact_users(spark, sf):
    return metrics.window_metrics(V.silver(spark, sf), "5 minutes", "1 minute", users="exact")


@query
def approx_users(spark, sf):
    window = ("5 minutes", "1 minute")
    keys = ["window_start", "window_end", "category", "product_id"]
    estimated = metrics.window_metrics(V.silver(spark, sf), *window).select(*keys, "active_users_approx")
    exact = metrics.window_metrics(V.silver(spark, sf), *window, users="exact").select(*keys, "active_users_exact")
    bound = metrics.estimate_in_bound("active_users_exact", "active_users_approx")
    return exact.join(estimated, keys).select(*keys, "active_users_exact", bound.alias("within_bound"))


@query
def merged_users(spark, sf):
    """Distinct users of sliding windows, weeks, categories and all events, merged from sketches per minute."""
    events = V.silver(spark, sf)
    sliding = F.date_format(F.window("slide_start", "5 minutes", "1 minute").start, "yyyy-MM-dd HH:mm")
    stored = through_table(metrics.user_sketches(events, ["category", "period"]), f"{shared_folder(spark)}/sketches")
    minutes = F.date_format(F.window("event_ts", "5 minutes", "1 minute").start, "yyyy-MM-dd HH:mm")
    grains = {
        "window": (sliding, minutes), "period": (F.col("period"),) * 2, "category": (F.col("category"),) * 2, "all": (F.concat(F.lit("all"), F.substring("period", 1, 0)),) * 2,
    }
    parts = []
    for grain, (merged_by, exact_by) in grains.items():
        # A window multiplies rows, so it is taken before the grouping.
        estimated = metrics.merge_users(stored.withColumn("key", merged_by), ["key"])
        exact = events.select(exact_by.alias("key"), "user_id").groupBy("key").agg(F.count_distinct("user_id").alias("active_users_exact"))
        parts.append(exact.join(estimated, "key").withColumn("grain", F.lit(grain)))
    bound = metrics.estimate_in_bound("active_users_exact", "active_users_approx")
    return reduce(DataFrame.unionByName, parts).withColumn("within_bound", bound).drop("active_users_approx")


@query
def snapshot_totals(spark, sf):
    return metrics.snapshot_totals(V.silver(spark, sf)).drop("active_users_approx")


@query
def approx_error(spark, sf):
    totals = metrics.snapshot_totals(V.silver(spark, sf))
    checked = metrics.with_estimate_error(totals, "active_users_exact", "active_users_approx")
    bound = metrics.estimate_in_bound("active_users_exact", "active_users_approx")
    return checked.select("active_users_exact", bound.alias("within_bound"), (F.col("observed_error") <= 0.15).alias("close"))


@query
def window_rollup(spark, sf):
    return metrics.window_rollup(V.tumbling(spark, sf))


@query
def source_isolation(spark, sf):
    real = F.col("product_id").startswith(V.NAMESPACE)
    events = V.mixed(spark, sf).withColumn("data_source", F.when(real, "real").otherwise("synthetic"))
    return metrics.snapshot_totals(events, ["data_source"]).drop("active_users_approx")


@query
def period_totals(spark, sf):
    rows = metrics.window_metrics(V.mixed(spark, sf), users=None)
    periods = {"All processed events": None, "Last 5 minutes": 5, "Last 15 minutes": 15, "Last 30 minutes": 30}
    return metrics.period_totals_each(rows, periods, V.NAMESPACE, real=True)


@query
def action_mix(spark, sf):
    return metrics.action_mix(metrics.window_rollup(V.tumbling(spark, sf)))


@query
def avg_purchase_value(spark, sf):
    return metrics.avg_purchase_value(metrics.window_rollup(V.tumbling(spark, sf)))


@query
def top_by_metric(spark, sf):
    rows, names = V.tumbling(spark, sf), ("views", "carts", "purchases", "revenue_paise")
    parts = [
        metrics.top_by_each(rows, names, grain).select(F.lit(grain).alias("grain"), "metric", "key", "value")
        for grain in ("product_id", "category")
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def trending(spark, sf):
    return metrics.trending(V.sliding(spark, sf))


@query
def display_labels(spark, sf):
    events = V.mixed(spark, sf).withColumn(
        "category", F.concat(F.lit("home."), F.col("category"), F.lit("_goods"))
    )
    listed = events.groupBy("product_id", "category").agg(
        F.count(F.lit(1)).alias("events"), F.sum(purchase_value()).alias("revenue_paise")
    )
    names = {"P01": "Kettle", "P02": "Floor lamp"}
    return reports.display_labels(listed, V.NAMESPACE, names, money="revenue_paise", symbol="€")


# --- serving ----------------------------------------------------------------------------


@query
def upsert_latest_wins(spark, sf):
    rows, commits = V.metrics_epochs(spark, sf)
    return latest_by_epoch(committed_only(rows, commits))


SIDES = {name.split("_")[-1] for name in C.EXACT_MEASURES}


@query
def reconcile(spark, sf):
    expected = V.tumbling(spark, sf)
    product = F.col("product_id")
    actual = expected.filter(product != "P01").withColumns(
        {
            "product_id": F.when(product == "P04", "PX4").otherwise(product),
            "views": F.when(product == "P02", F.col("views") + 1).otherwise(F.col("views")),
        }
    )
    found = agreement.reconcile(expected, actual)
    return found.withColumns({c: F.col(c).cast("double") for c in found.columns if c.split("_")[-1] in SIDES})


# --- customers and products -------------------------------------------------------------


def _periods(spark, sf):
    return customers.customer_periods(V.history(spark, sf))


@query
def monthly_summary(spark, sf):
    return customers.period_summary(_periods(spark, sf), estimate=False)


@query
def history_overview(spark, sf):
    return customers.history_overview(customers.period_summary(_periods(spark, sf), estimate=False))


@query
def customer_months(spark, sf):
    return customers.with_first_observed(_periods(spark, sf))


@query
def first_observed(spark, sf):
    return customers.first_observed(_periods(spark, sf))


@query
def customer_behaviour(spark, sf):
    return customers.customer_behaviour(_periods(spark, sf))


@query
def category_interest(spark, sf):
    return customers.category_interest(V.history(spark, sf))


@query
def product_totals(spark, sf):
    return customers.product_totals(V.history(spark, sf))


def _products(spark, sf):
    events = V.history(spark, sf)
    return customers.product_performance(
        customers.product_totals(events), customers.matched_buyers(journeys.journey_pairs(events))
    )


@query
def product_performance(spark, sf):
    return _products(spark, sf)


@query
def matched_buyers(spark, sf):
    return customers.matched_buyers(journeys.journey_pairs(V.history(spark, sf)))


@query
def top_products(spark, sf):
    return customers.top_products(_products(spark, sf))


@query
def rank_products(spark, sf):
    return customers.rank_products(customers.top_products(_products(spark, sf)), "observed_conversion_pct")


# --- sessions ---------------------------------------------------------------------------


@query
def journey_pairs(spark, sf):
    return journeys.journey_pairs(V.history(spark, sf))


@query
def view_to_purchase(spark, sf):
    return journeys.view_to_purchase(V.history(spark, sf))


@query
def time_to_purchase(spark, sf):
    return journeys.time_to_purchase(journeys.view_to_purchase(V.history(spark, sf)))


@query
def funnel_batch(spark, sf):
    events = V.silver(spark, sf).withColumn(
        "session_observed", F.when(F.col("source_row") % 5 != 4, F.col("source_row") % 5 != 0)
    )
    clocked = metrics.analysis_clock(events, real=False)
    funnel = journeys.cart_funnel(clocked, ["session_id"], "analysis_ts", observed_only=True)
    return journeys.with_funnel_rate(funnel)


@query
def funnel_history(spark, sf):
    funnel = journeys.cart_funnel(V.history(spark, sf), ["user_id", "session_id"], "event_time")
    return journeys.with_funnel_rate(funnel)


@query
def inferred_sessions(spark, sf):
    return journeys.inferred_sessions(V.history(spark, sf))


@query
def inferred_session_count(spark, sf):
    return journeys.inferred_session_count(journeys.inferred_sessions(V.history(spark, sf)))


@query
def session_timelines(spark, sf):
    return journeys.session_timelines(V.history(spark, sf))


# --- samples and sketches ---------------------------------------------------------------


@query
def hash_sample(spark, sf):
    return sampling.hash_sample(V.silver(spark, sf), 0.1).select("event_id", "event_type", "price_paise")


@query
def sample_estimate(spark, sf):
    return sampling.sample_estimate(V.silver(spark, sf)).drop("exact_events", "exact_revenue_paise")


@query
def sampling_error(spark, sf):
    return sampling.with_sampling_error(sampling.sample_estimate(V.silver(spark, sf)))


@query
def reservoir_sample(spark, sf):
    return sampling.uniform_sample(V.silver(spark, sf)).select("event_id", "product_id")


@query
def cms_estimate(spark, sf):
    return sketches.cms_comparison(V.silver(spark, sf), "user_id")


@query
def bloom_membership(spark, sf):
    """Filter of the purchase ids, asked for all purchases and for all other events."""
    events = V.silver(spark, sf)
    bought = events.filter(F.col("event_type") == "purchase")
    others = events.filter(F.col("event_type") != "purchase")
    capacity = max(1, bought.count())
    bits = sketches.bloom_build(bought, "event_id", capacity)
    report = sketches.bloom_report(sketches.bloom_contains(bits, others, "event_id", capacity))
    missed = sketches.bloom_contains(bits, bought, "event_id", capacity).agg(
        F.count(F.lit(1)).alias("inserted"), F.count_if(~F.col("maybe_present")).alias("false_negatives")
    )
    return reports.one_row(spark, report=report, missed=missed).select("report.*", "missed.*")


@query
def price_quantiles(spark, sf):
    """Prices of each product from sketches per product and day, and whether their ranks are within bounds."""
    events = V.silver(spark, sf)
    daily = quantiles.value_sketches(events.withColumn("day", F.to_date("event_ts")), ["product_id", "day"], "price_paise")
    merged = quantiles.merge_sketches(daily, ["product_id"])
    found = quantiles.quantiles(merged, [0.1, 0.5, 0.95])
    return quantiles.rank_checked(found, events, ["product_id"], "price_paise").drop("quantile")


@query
def purchase_time_quantiles(spark, sf):
    """Seconds from view to purchase of each product, from sketches per product and day."""
    timings = journeys.view_to_purchase(V.history(spark, sf))
    daily = quantiles.value_sketches(
        timings.withColumn("day", F.to_date("first_view")), ["product_id", "day"], "seconds_to_purchase"
    )
    found = quantiles.quantiles(quantiles.merge_sketches(daily, ["product_id"]), [0.5, 0.9])
    return quantiles.rank_checked(found, timings, ["product_id"], "seconds_to_purchase").drop("quantile")


# --- files: history, evolution, prefixes --------------------------------------------------


def _csv_files(spark, sf, folder: str, compression: str) -> str:
    """The month as CSV files in row order, one after the other."""
    rows = V.csv_rows(spark, sf).repartitionByRange(6, "source_row").sortWithinPartitions("source_row")
    fields = rows.select(*C.HISTORY_CSV_FIELDS)
    fields.write.option("header", True).option("emptyValue", "").option("compression", compression).csv(folder)
    return folder


@query
def source_rows(spark, sf):
    """Row numbers of a month of plain and of gzip CSV files."""
    parts = []
    for kind in ("none", "gzip"):
        rows = read_history_csv(spark, _csv_files(spark, sf, shared_folder(spark), kind))
        parts.append(rows.select(F.lit(kind).alias("compression"), "source_row", "event_time", "product_id", "price"))
    return reduce(DataFrame.unionByName, parts)


_imported: dict[tuple[str, str], str] = {}


def _history_root(spark, sf) -> str:
    """The event table imported as a published month; once per application and table folder."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _imported:
        folder = shared_folder(spark)
        import_month(spark, _csv_files(spark, sf, f"{folder}/csv", "none"), V.MONTH, f"{folder}/history", V.ID_PREFIX)
        _imported[key] = f"{folder}/history"
    return _imported[key]


@query
def month_import(spark, sf):
    """The manifest of an imported month, and whether the stored events agree with it."""
    root = _history_root(spark, sf)
    stored = read_months(spark, root).agg(F.count(F.lit(1)).alias("stored_rows"))
    manifest = read_manifests(spark, root).drop("source", "coverage", "scope")
    return reports.one_row(spark, manifest=manifest, stored=stored).select("manifest.*", "stored.*")


@query
def month_events(spark, sf):
    """Events of an imported month, as published."""
    return read_months(spark, _history_root(spark, sf))


@query
def month_rejects(spark, sf):
    """Refused records of an imported month, read back from its JSON files."""
    path = f"{_history_root(spark, sf)}/months/{V.MONTH}/rejected"
    kind = T.StructType([T.StructField("source_row", T.LongType()), T.StructField("reason", T.StringType()), T.StructField("record", schemas.HISTORY_CSV)])
    return spark.read.schema(kind).json(path).select("source_row", "reason", F.col("record.price").alias("price"))


@query
def republished_dates(spark, sf):
    """History by date, of which two dates are published again with other prices."""
    folder = shared_folder(spark)
    events = V.history(spark, sf).select("event_id", "event_time", "price_minor").withColumn("event_date", F.to_date("event_time").cast("string"))
    write_by_date(events, folder)
    again = events.filter(F.col("event_date").isin("2024-01-05", "2024-01-20")).withColumn("price_minor", F.col("price_minor") + 1)
    republish_dates(again, folder)
    return spark.read.schema(events.schema).parquet(folder)


def _by_customer(spark, sf) -> DataFrame:
    folder = shared_folder(spark)
    name = "events_" + folder.rsplit("/", 1)[1]
    return write_by_customer(V.history(spark, sf), folder, name, buckets=8)


@query
def bucketed_customers(spark, sf):
    """Customer periods from events stored by customer: no exchange."""
    return customers.customer_periods(_by_customer(spark, sf))


@query
def bucketed_journeys(spark, sf):
    """Milestones of every customer, session and product from events stored by customer: no exchange."""
    return journeys.journey_pairs(_by_customer(spark, sf))


@query
def merged_scan(spark, sf):
    """Two generations of stored events, the older without provenance columns."""
    folder = shared_folder(spark)
    events = contract.valid_events(contract.parse_events(V.raw(spark, sf)))
    older = F.col("source_row") % 2 == 0
    provenance = ["data_source", "source_event_time", "currency", "session_observed", "quantity_observed", "source_row"]
    events.filter(older).drop(*provenance).write.parquet(f"{folder}/generation=1")
    events.filter(~older).write.parquet(f"{folder}/generation=2")
    return scan_silver(spark, folder, merge=True).select("event_id", "event_ts", "price_paise", F.col("source_row").cast("double").alias("source_row"), "generation")


@query
def months_union(spark, sf):
    """Weeks stored as tables of their own, of which some lack a column, read as one."""
    folder = shared_folder(spark)
    V.history(spark, sf).select("event_id", "event_type", "category", "period").write.partitionBy("period").parquet(folder)
    frames = []
    for number in range(5):
        week = spark.read.parquet(f"{folder}/period=w{number}")
        frames.append(week if number % 2 else week.drop("category"))
    return customers.union_months(frames)


@query
def path_prefix_sample(spark, sf):
    """The first 500 events in the order of their files; files behind them stay closed."""
    folder = shared_folder(spark)
    rows = V.silver(spark, sf).select("event_id", "source_row", "event_type")
    rows.repartitionByRange(8, "source_row").sortWithinPartitions("source_row").write.parquet(folder)
    return path_prefix(spark, folder, 500)


@query
def recent_events_pruned(spark, sf):
    """The newest records of one source, from the newest folders alone."""
    folder = shared_folder(spark)
    reports.write_by_ingestion(_sourced(spark, sf), folder, "yyyyMMdd")
    shown = reports.recent_events(reports.newest_ingested(spark, folder), "real")
    product = F.get_json_object("raw_json", "$.product_id").alias("product_id")
    return shown.select("topic", "partition", "offset", "ingested_at", product)


LINES_A_FILE = 250_000  # events whose lines one task puts in order


def _line_files(spark, sf) -> int:
    return max(4, math.ceil(V.table(spark, sf, "events").count() / LINES_A_FILE))


@query
def json_lines(spark, sf):
    """Raw records as lines of a JSON file, numbered and routed."""
    folder = shared_folder(spark)
    files = _line_files(spark, sf)
    lines = V.raw_bad(spark, sf).repartitionByRange(files, "offset").sortWithinPartitions("offset")
    lines.select("raw_json").write.text(folder)
    parsed = contract.parse_events(read_json_lines(spark, folder, datetime(2025, 1, 1)))
    return parsed.select(F.col("offset").alias("line"), "valid")


@query
def nested_timelines(spark, sf):
    """The first actions of a few sessions, as lists."""
    nested = journeys.nest_timelines(journeys.session_timelines(V.history(spark, sf)))
    steps = F.array_join(F.transform("timeline", lambda e: F.concat_ws(":", e["event_type"], e["product_id"])), ",")
    return nested.select("user_id", "session_id", "total_actions", F.size("timeline").alias("shown"), steps.alias("steps"))


@query
def snapshot_report(spark, sf):
    """The stored report of a snapshot: written as JSON sections, read back as one document."""
    folder = shared_folder(spark)
    silver, refused = contract.split_valid(contract.parse_events(V.raw_dup(spark, sf)))
    silver.write.parquet(f"{folder}/silver")
    run_snapshot(spark, f"{folder}/silver", f"{folder}/out", V.NAMESPACE, run_id="r")
    stored = spark.read.schema("run_id string, summary string").json(f"{folder}/out/reports")
    windows = spark.read.parquet(f"{folder}/out/windows").agg(F.count(F.lit(1)).alias("windows"), F.sum("events").alias("window_events"))
    return reports.one_row(spark, report=stored, windows=windows).select(
        "report.run_id",
        *[
            F.get_json_object("report.summary", f"$.{section}{name}").cast("bigint").alias(name)
            for section, names in (("totals.", ("events", "purchases", "revenue_paise", "active_users_exact")), ("session_funnel.", ("cart_sessions", "converted_sessions")), ("", ("conflicting_event_ids",)))
            for name in names
        ],
        F.get_json_object("report.summary", "$.definition").alias("definition"),
        "windows.*",
    )


@query
def customer_report(spark, sf):
    """The months of the published customer report, read back from its document."""
    root = _history_root(spark, sf)
    run_customer_report(spark, root)
    document = spark.read.text(f"{root}/customer-report.json", wholetext=True)
    kind = "array<struct<period: string, actions: bigint, customers: bigint, views: bigint, carts: bigint, purchases: bigint, purchase_price_sum: double>>"
    months = F.from_json(F.get_json_object("value", "$.monthly"), kind)
    accepted = F.get_json_object("value", "$.accepted_rows").cast("bigint").alias("accepted_rows")
    return document.select(accepted, F.inline(months))


@query
def fixture_report(spark, sf):
    """Totals of the report of a JSON file with refused and repeated lines."""
    folder = shared_folder(spark)
    files = _line_files(spark, sf)
    lines = V.raw_bad(spark, sf).select("raw_json", "offset")
    lines = lines.unionByName(lines.filter(F.col("offset") % 10 == 9)).repartitionByRange(files, "offset").sortWithinPartitions("offset")
    lines.select("raw_json").write.text(f"{folder}/lines")
    run_fixture_report(spark, f"{folder}/lines", f"{folder}/out", datetime(2025, 1, 1))
    kind = "input_lines bigint, duplicate_records bigint, events bigint, purchases bigint, revenue_paise bigint"
    return spark.read.schema(kind).json(f"{folder}/out/totals")


# --- reports ----------------------------------------------------------------------------


@query
def batch_report(spark, sf):
    events = V.silver(spark, sf)
    report = reports.batch_report(
        metrics.snapshot_totals(events).drop("active_users_approx"),
        sampling.sample_estimate(events, [0.1]).drop("exact_events", "exact_revenue_paise"),
        journeys.cart_funnel(
            metrics.analysis_clock(events, False).withColumn("session_observed", F.lit(True)),
            ["session_id"],
            "analysis_ts",
            observed_only=True,
        ),
        dedup.conflicting_ids(contract.parse_events(V.raw_conflict(spark, sf)).filter("valid")),
        "synthetic",
        "events",
    )
    return report.select("data_source", "source", "totals.*", "sampling.*", "session_funnel.*", "conflicting_event_ids", "definition")


@query
def nearest_rank(spark, sf):
    return ranking.nearest_rank(V.silver(spark, sf), "event_type", "price_paise", [0.5, 0.95])


# --- streams ----------------------------------------------------------------------------

_finished: dict[tuple[str, str], Pipeline] = {}


def _streamed(spark: SparkSession, sf: str) -> Pipeline:
    """The whole pipeline over the event table as a stream; once per application and table folder.

    Every tenth record is delivered twice.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _finished:
        folder = shared_folder(spark)
        schema = V.table(spark, sf, "events").schema
        events = spark.readStream.schema(schema).parquet(f"{sf}/events.parquet*")
        copies = F.when(F.col("source_row") % 10 == 9, 1).otherwise(0)
        twice = V.canonical(V.spread(events)).withColumn("_copy", F.explode(F.sequence(F.lit(0), copies)))
        pipeline = Pipeline(f"{folder}/lake", f"{folder}/checkpoints")
        pipeline.run_available(V.as_raw(twice))
        _finished[key] = pipeline
    return _finished[key]


@query
def stream_silver(spark, sf):
    return spark.read.parquet(_streamed(spark, sf).silver).select(*EVENT_OUT)


@query
def stream_quarantine(spark, sf):
    refused = spark.read.parquet(_streamed(spark, sf).quarantine)
    return refused.select("topic", "partition", "offset", "ingested_at")


@query
def stream_tumbling(spark, sf):
    return latest_metrics(spark, _streamed(spark, sf).serving, C.SALES).drop(C.APPROX_MEASURE, "epoch_id")


@query
def stream_sliding(spark, sf):
    return latest_metrics(spark, _streamed(spark, sf).serving, C.TRENDING).drop(C.APPROX_MEASURE, "epoch_id")


_delivered: dict[tuple[str, str], tuple[Pipeline, str]] = {}


def _deliveries(spark: SparkSession, sf: str) -> tuple[Pipeline, str]:
    """The pipeline restarted for every delivery of the event table, and the table of its reports.

    Each round starts all five queries again from their checkpoints, so the watermark of a round comes
    from the rounds before. Once per application and table folder.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _delivered:
        folder = shared_folder(spark)
        pipeline = Pipeline(f"{folder}/lake", f"{folder}/checkpoints", V.WATERMARK)
        records = through_table(V.delivered(spark, sf), f"{folder}/records")
        with health.recording(spark, f"{folder}/progress"):
            for number in range(V.ROUNDS):
                records.filter(F.col("partition") == number).write.mode("append").parquet(f"{folder}/source")
                pipeline.run_available(stream_files(spark, schemas.RAW, f"{folder}/source"))
        _delivered[key] = pipeline, f"{folder}/progress"
    return _delivered[key]


def _reports(spark, sf):
    return health.read_progress(spark, _deliveries(spark, sf)[1])


@query
def stream_late_rows(spark, sf):
    """By delivery: records that came in, late and repeated ones from the reports, accepted ones from silver."""
    counters = health.batch_counters(_reports(spark, sf)).filter(F.col("query_name") == C.SILVER)
    number = F.row_number().over(Window.orderBy("batch_id")) - 1  # one row per delivery
    counters = counters.withColumn("round", number)
    stored = spark.read.parquet(_deliveries(spark, sf)[0].silver)
    kept = stored.groupBy(F.col("partition").alias("round")).agg(F.count(F.lit(1)).alias("accepted"))
    return counters.join(kept, "round", "left").select(
        "round", F.col("input_rows").alias("delivered"), "late", "repeated", F.coalesce("accepted", F.lit(0)).alias("accepted")
    )


@query
def stream_restart(spark, sf):
    """Minute totals after five starts from the same checkpoints."""
    return latest_metrics(spark, _deliveries(spark, sf)[0].serving, C.SALES).drop(C.APPROX_MEASURE, "epoch_id")


@query
def stream_state(spark, sf):
    """Ids that silver still remembers after the last delivery, from its state store."""
    return remembered_ids(spark, f"{_deliveries(spark, sf)[0].checkpoints}/{C.SILVER}")


@query
def pipeline_health(spark, sf):
    """Health at the time of each query's last report, and an hour after it."""
    reported = _reports(spark, sf)
    now = health.pipeline_health(reported, F.col("updated_at"))
    later = health.pipeline_health(reported, F.col("updated_at") + F.expr("INTERVAL 1 HOUR"))
    later = later.select("query_name", F.col("state").alias("state_later"), F.col("seconds_since_update").alias("seconds_later"))
    return now.join(later, "query_name")


@query
def quality_counters(spark, sf):
    counters = health.quality_counters(_reports(spark, sf)).drop("batch_id")
    return counters.withColumns({c: F.col(c).cast("double") for c in counters.columns if c.endswith("removed")})


@query
def stage_throughput(spark, sf):
    rates = health.stage_throughput(_reports(spark, sf))
    return rates.withColumn("measured", F.col("rows_per_second") > 0).drop("rows_per_second")
