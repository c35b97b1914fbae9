"""Prepare a positioned replay table from a CSV prefix."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from basketline.functions.ranking import dense_position
from basketline.operators.normalize import REPLAY_FIELDS, route_replay, source_prefix
from basketline.session import path_exists
from basketline.sources.history import read_history_csv


def positioned_replay(rows: DataFrame, namespace: str, id_prefix: str) -> DataFrame:
    """Accepted events numbered 1..n in source order."""
    routed = route_replay(rows, namespace, id_prefix)
    accepted = routed.filter(F.col("reject_reason").isNull()).select(*REPLAY_FIELDS)
    return dense_position(accepted, "source_row")


def prepare_replay(
    spark: SparkSession, source: str, output: str, namespace: str, id_prefix: str, rows: int | None = None
) -> Row:
    """Write the positioned table of all source rows, or the first ``rows``, and return its manifest.

    An existing table is kept: a replay in progress must not change under its cursor.
    """
    if path_exists(spark, f"{output}/events/_SUCCESS"):
        raise FileExistsError(f"{output} already holds a prepared replay")
    source_rows = read_history_csv(spark, source)
    picked = source_rows if rows is None else source_prefix(source_rows, rows)
    routed = route_replay(picked, namespace, id_prefix)
    table = positioned_replay(picked, namespace, id_prefix)
    table.repartitionByRange("position").write.mode("overwrite").parquet(f"{output}/events")
    kept = F.col("reject_reason").isNull()
    manifest = routed.agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if(kept).alias("accepted_rows"),
        F.count_if(~kept).alias("rejected_rows"),
        F.min(F.when(kept, F.col("source_event_time"))).alias("first_event_time"),
        F.max(F.when(kept, F.col("source_event_time"))).alias("last_event_time"),
    )
    manifest.coalesce(1).write.mode("overwrite").json(f"{output}/manifest")
    return spark.read.schema(manifest.schema).json(f"{output}/manifest").first()
