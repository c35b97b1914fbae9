"""Publish one month of history: partitioned events, rejects and a manifest, all or nothing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketline import constants as C
from basketline.operators.normalize import import_manifest, rejects, route_history
from basketline.session import hadoop_path, path_exists
from basketline.sources.history import MANIFEST, read_history_csv


class RowsLost(RuntimeError):
    """Stored rows do not add up to the rows of the source."""


def write_by_date(df: DataFrame, path: str, *leading: str) -> None:
    """zstd Parquet partitioned by date.

    Rebalancing brings the rows of a date together but lets adaptive execution cut a large date into
    several tasks, so a busy day is neither one task nor a thousand tiny files.
    """
    columns = [*leading, "event_date"]
    (
        df.hint("rebalance", *columns)
        .write.mode("overwrite")
        .partitionBy(*columns)
        .option("compression", "zstd")
        .parquet(path)
    )


def republish_dates(df: DataFrame, path: str) -> None:
    """Put the dates that ``df`` has in the place of those at ``path``; all other dates stay as they are."""
    (
        df.hint("rebalance", "event_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date")
        .option("compression", "zstd")
        .parquet(path)
    )


def write_by_customer(df: DataFrame, path: str, table: str, buckets: int, key: str = "user_id") -> DataFrame:
    """Store the events as a table of ``buckets`` files by customer, sorted, and return it.

    Groupings and joins on the customer, or on keys that contain it, then need no exchange. All rows of a
    customer are in one file: where one customer holds a large share, keep the layout by date instead.
    """
    placed = df.repartition(buckets, key)
    placed.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
    return df.sparkSession.table(table)


def write_rejects(rejected: DataFrame, path: str) -> None:
    rejected.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def _move(spark: SparkSession, source: str, target: str) -> None:
    src, fs = hadoop_path(spark, source)
    dst, _ = hadoop_path(spark, target)
    fs.mkdirs(dst.getParent())
    if fs.exists(dst) or not fs.rename(src, dst):
        raise RuntimeError(f"could not publish {source} as {target}")


def month_manifest(spark: SparkSession, root: str, month: str):
    return spark.read.schema(MANIFEST).json(f"{root}/months/{month}/manifest").first()


def import_month(
    spark: SparkSession, source: str, month: str, root: str, id_prefix: str, official: bool = False
):
    """Import ``source`` as ``root/months/<month>`` and return its manifest row.

    The CSV is normalised and written once, accepted and rejected rows side by side in a staging
    folder of this attempt. Counts are checked on what was stored; the month appears by a rename, and
    a month that already has a manifest is left alone.
    """
    final = f"{root}/months/{month}"
    if path_exists(spark, f"{final}/manifest/_SUCCESS"):
        return month_manifest(spark, root, month)
    stage = f"{root}/staging/{month}-{uuid.uuid4().hex}"
    routed = route_history(read_history_csv(spark, source), month, id_prefix)
    kept = F.col("reject_reason").isNull()
    routed = routed.withColumn("outcome", F.when(kept, "accepted").otherwise("rejected"))
    routed = routed.withColumn("event_date", F.when(kept, F.col("event_date")).otherwise("none"))
    write_by_date(routed, f"{stage}/rows", "outcome")

    stored = spark.read.schema(routed.schema).parquet(f"{stage}/rows")
    counts = import_manifest(stored).first()
    last_row = stored.agg(F.max("source_row").alias("n")).first()["n"]
    if not counts["accepted_rows"]:
        raise ValueError("no valid rows found")
    if counts["source_rows"] != last_row:
        raise RowsLost(f"{counts['source_rows']} rows stored of {last_row}")
    write_rejects(rejects(stored.filter(F.col("outcome") == "rejected")), f"{stage}/rejected")
    _move(spark, f"{stage}/rows/outcome=accepted", f"{stage}/events")
    coverage = C.COVERAGE_OFFICIAL if official else C.COVERAGE_SUPPLIED
    manifest = spark.createDataFrame(
        [
            {
                **counts.asDict(),
                "month": month,
                "status": C.MONTH_COMPLETE,
                "coverage": coverage,
                "source": source,
                "scope": C.HISTORY_SCOPE,
            }
        ],
        MANIFEST,
    )
    manifest.coalesce(1).write.mode("overwrite").json(f"{stage}/manifest")
    _move(spark, stage, final)
    return month_manifest(spark, root, month)

