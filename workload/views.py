"""The driver tables seen as commerce events. Each view is a projection of ``events``.

The same rules as DuckDB text are in ``oracles.py``; views with JSON text exist only on this side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketline import constants as C
from basketline.operators.metrics import window_metrics
from basketline.session import pin_runtime

NAMESPACE = "real:"
MONTH = "2024-Jan"
ID_PREFIX = "shop"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_runtime(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def canonical(events: DataFrame) -> DataFrame:
    """Event stream rows as shopping events; works on a streaming frame as well."""
    k = F.regexp_extract("props", r'"k": *(\d+)', 1).try_cast("bigint")  # cheaper than a JSON parser per use
    week = F.concat(F.lit("w"), F.floor((F.day("ts") - 1) / F.lit(7)).cast("string"))
    user = F.col("user_id").cast("string")
    kind = (
        F.when(F.col("event_type") == "click", "cart")
        .when(F.col("event_type") == "signup", "search")
        .otherwise(F.col("event_type"))
    )
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("event_id").alias("source_row"),
        F.col("ts").cast("timestamp").alias("event_ts"),
        user.alias("user_id"),
        F.concat(user, F.lit("-"), week).alias("session_id"),
        kind.alias("event_type"),
        F.concat(F.lit("P0"), (k % 10).cast("string")).alias("product_id"),
        F.concat(F.lit("C"), (k % 10 % 3).cast("string")).alias("category"),
        (1 + k % 3).alias("quantity"),
        F.round(F.col("value") * 100).cast("bigint").alias("price_paise"),
        week.alias("period"),
    )


def spread(events: DataFrame) -> DataFrame:
    """Events dealt out evenly by id: records are written and parsed in as many tasks as the cluster has cores for,
    however few row groups the table has, and however its order follows the time."""
    cores = events.sparkSession.sparkContext.defaultParallelism
    return events.repartition(2 * cores, "event_id")


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    return canonical(table(spark, sf_dir, "events"))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that satisfy the contract: everything but the ``error`` actions."""
    events = table(spark, sf_dir, "events")
    return canonical(events.filter(F.col("event_type") != "error"))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events with the column names of history."""
    return silver(spark, sf_dir).withColumnsRenamed({"event_ts": "event_time", "price_paise": "price_minor"})


def mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second event comes from a namespaced source."""
    events = silver(spark, sf_dir)
    real = F.col("source_row") % 2 == 0
    return events.withColumns(
        {
            name: F.when(real, F.concat(F.lit(NAMESPACE), name)).otherwise(F.col(name))
            for name in ("product_id", "user_id", "session_id")
        }
    )


def iso(ts: Column, zone: str = "+00:00") -> Column:
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit(zone))


def as_raw(
    events: DataFrame, partition: Column | None = None, ingested_at: Column | None = None, **changes: Column
) -> DataFrame:
    """Encode events as raw JSON records with log coordinates."""
    partition = F.col("source_row") % 3 if partition is None else partition
    ingested_at = F.col("event_ts") + F.expr("INTERVAL 1 SECOND") if ingested_at is None else ingested_at
    fields = {
        "schema_version": F.lit(C.SCHEMA_VERSION),
        "event_id": F.col("event_id"),
        "event_time": iso(F.col("event_ts")),
        "user_id": F.col("user_id"),
        "session_id": F.col("session_id"),
        "event_type": F.col("event_type"),
        "product_id": F.col("product_id"),
        "product_name": F.concat(F.lit("Item "), F.col("product_id")),
        "category": F.col("category"),
        "quantity": F.col("quantity"),
        "price_paise": F.col("price_paise"),
        "source_row": F.col("source_row"),
        **changes,
    }
    return events.select(
        F.to_json(F.struct(*[column.alias(name) for name, column in fields.items()])).alias("raw_json"),
        F.lit("t").alias("topic"),
        partition.cast("int").alias("partition"),
        F.col("source_row").alias("offset"),
        ingested_at.alias("ingested_at"),
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_raw(ev(spark, sf_dir))


def raw_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records of which some break one rule each, chosen by ``source_row % 50``."""
    events = ev(spark, sf_dir)
    case = F.col("source_row") % 50

    def bad(number: int, value: Column, normal: Column) -> Column:
        return F.when(case == number, value).otherwise(normal)

    late = F.col("event_ts") + F.expr("INTERVAL 6 MINUTES 1 SECOND")
    instant = F.when(case == 5, late).otherwise(F.col("event_ts"))
    frame = as_raw(
        events,
        schema_version=bad(1, F.lit(2), F.lit(C.SCHEMA_VERSION)),
        event_id=bad(3, F.lit(" \t"), F.col("event_id")),
        event_time=F.when(case == 2, iso(F.col("event_ts"), "")).otherwise(iso(instant)),
        category=bad(6, F.repeat(F.lit("x"), 129), F.col("category")),
        quantity=bad(0, F.lit(0).cast("bigint"), F.col("quantity")),
        price_paise=bad(7, F.lit(-1).cast("bigint"), F.col("price_paise")),
    )
    broken = F.substring("raw_json", 1, 20)
    return frame.withColumn("raw_json", F.when(F.col("offset") % 50 == 4, broken).otherwise(F.col("raw_json")))


def raw_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records of which every tenth arrives again, a second later and with a higher offset."""
    events = ev(spark, sf_dir)
    again = as_raw(events.filter(F.col("source_row") % 10 == 9)).withColumns(
        {
            "offset": F.col("offset") + 1_000_000_000,
            "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 SECOND"),
        }
    )
    return as_raw(events).unionByName(again)


def raw_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records of which some arrive again with another price."""
    events = ev(spark, sf_dir)
    other = as_raw(events.filter(F.col("source_row") % 100 == 7), price_paise=F.col("price_paise") + 1)
    return as_raw(events).unionByName(other)


def csv_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nine text fields of a monthly file, with some rows spoilt by ``source_row % 40``."""
    events = ev(spark, sf_dir)
    case = F.col("source_row") % 40
    price = F.col("price_paise").cast("decimal(20,0)") / F.lit(100).cast("decimal(3,0)")
    when = F.when(case == 2, F.col("event_ts") - F.expr("INTERVAL 31 DAYS")).otherwise(F.col("event_ts"))
    return events.select(
        F.date_format(when, "yyyy-MM-dd HH:mm:ss 'UTC'").alias("event_time"),
        F.when(case == 3, "refund").otherwise(F.col("event_type")).alias("event_type"),
        "product_id",
        F.concat(F.lit("90"), F.substring("category", 2, 9)).alias("category_id"),
        F.when(case == 6, "").otherwise(F.lower("category")).alias("category_code"),
        F.concat(F.lit("brand-"), F.substring("product_id", 2, 9)).alias("brand"),
        F.when(case == 0, "NaN").when(case == 1, "1.001").otherwise(price.cast("decimal(20,2)").cast("string")).alias(
            "price"
        ),
        F.when(case == 4, "").otherwise(F.col("user_id")).alias("user_id"),
        F.when(case == 5, "").otherwise(F.col("session_id")).alias("user_session"),
        "source_row",
    )


def tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_metrics(silver(spark, sf_dir), users=None)


def sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_metrics(silver(spark, sf_dir), "5 minutes", "1 minute", users=None)


def metrics_epochs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(rows, commits) of a changelog: half counts as epoch 0, the metrics as epoch 1, an uncommitted
    epoch 2 with ten times the counts."""
    metrics = tumbling(spark, sf_dir).withColumn("query_name", F.lit(C.SALES))
    epochs = F.explode(F.array(F.lit(0), F.lit(1), F.lit(2)).cast("array<bigint>"))
    rows = metrics.withColumn("epoch_id", epochs)
    rows = rows.withColumns(
        {
            name: F.when(F.col("epoch_id") == 0, F.floor(F.col(name) / 2))
            .when(F.col("epoch_id") == 2, F.col(name) * 10)
            .otherwise(F.col(name))
            .cast("bigint")
            for name in C.EXACT_MEASURES
        }
    )
    commits = metrics.select("query_name").distinct().withColumn("epoch_id", F.explode(F.expr("array(0L, 1L)")))
    return rows, commits


ROUNDS = 5  # deliveries of the event table: one for each week
WATERMARK = "10 days"


def delivered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw records with the delivery they arrive in as ``partition``, in event-time order but for some.

    Of twenty records one arrives up to three weeks late and one a week late; two arrive a second time,
    a week later. Nothing arrives after the last delivery.
    """
    events = canonical(spread(table(spark, sf_dir, "events")))
    week = F.floor((F.day("event_ts") - 1) / F.lit(7)).cast("int")
    later = lambda weeks: F.least(week + weeks, F.lit(ROUNDS - 1))
    row = F.col("source_row")
    rounds = (
        F.when(row % 20 == 3, F.array(later(3)))
        .when(row % 20 == 13, F.array(later(1)))
        .when(row % 10 == 9, F.array(week, later(1)))
        .otherwise(F.array(week))
    )
    events = events.withColumn("_week", week).withColumn("_round", F.explode(rounds))
    delay = F.make_dt_interval(days=(F.col("_round") - F.col("_week")) * 7, secs=F.lit(1))
    return as_raw(events, partition=F.col("_round"), ingested_at=F.col("event_ts") + delay)
