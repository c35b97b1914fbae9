"""Micro-batch progress as rows, and the health, quality and speed read from it."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from basketline import constants as C
from basketline import schemas

REPORTS_WITHIN = 600_000  # milliseconds


def progress_row(name: str, progress) -> tuple:
    """One progress report as a row of the progress table."""
    return name, progress.batchId, progress.json, datetime.now(timezone.utc).replace(tzinfo=None)


def progress_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, schemas.PROGRESS)


def append_progress(spark: SparkSession, rows: list[tuple], path: str) -> None:
    if rows:
        progress_frame(spark, rows).coalesce(1).write.mode("append").parquet(path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.PROGRESS).parquet(path)


class ProgressRecorder(StreamingQueryListener):
    """Collects every batch report of the queries that start while it listens; ``flush`` appends them to the progress table.

    Reports arrive behind their batches, so those of a query that ended before may still be on their way.
    """

    def __init__(self) -> None:
        self._rows: list[tuple] = []
        self._runs: set[str] = set()
        self._lock = threading.Lock()

    def onQueryStarted(self, event) -> None:
        with self._lock:
            self._runs.add(str(event.runId))

    def onQueryProgress(self, event) -> None:
        with self._lock:
            if str(event.progress.runId) not in self._runs:
                return
            self._rows.append(progress_row(event.progress.name, event.progress))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def flush(self, spark: SparkSession, path: str) -> int:
        with self._lock:
            rows, self._rows = self._rows, []
        append_progress(spark, rows, path)
        return len(rows)


@contextmanager
def recording(spark: SparkSession, path: str) -> Iterator[ProgressRecorder]:
    """Append the reports of all streams that run inside to the progress table at ``path``."""
    recorder = ProgressRecorder()
    spark.streams.addListener(recorder)
    try:
        yield recorder
        # Reports arrive behind their batches; on a busy driver by more than the 10 seconds waited for without a limit.
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(REPORTS_WITHIN)
    finally:
        spark.streams.removeListener(recorder)
        recorder.flush(spark, path)


def collected_progress(queries: list[StreamingQuery]) -> DataFrame:
    """Recent reports of the given queries."""
    rows = [progress_row(q.name, p) for q in queries for p in q.recentProgress]
    return progress_frame(SparkSession.active(), rows)


def latest_progress(progress: DataFrame) -> DataFrame:
    """Newest report of every query."""
    newest = Window.partitionBy("query_name").orderBy(F.desc("updated_at"), F.desc("batch_id"))
    return progress.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def _instant(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def pipeline_health(progress: DataFrame, as_of, fresh_seconds: int = 30) -> DataFrame:
    """Per query: label, seconds since its last report at ``as_of``, and whether that is recent."""
    labels = F.create_map(*[F.lit(x) for pair in C.STAGE_LABELS.items() for x in pair])
    age = F.greatest(
        F.unix_micros(_instant(as_of)) - F.unix_micros(F.col("updated_at").cast("timestamp")), F.lit(0)
    ) / F.lit(1e6)
    state = F.when(F.col("_age") < fresh_seconds, "Recent progress").otherwise("Idle or needs checking")
    return (
        latest_progress(progress)
        .withColumn("_age", age)
        .select(
            "query_name",
            F.coalesce(F.try_element_at(labels, F.col("query_name")), F.col("query_name")).alias("step"),
            state.alias("state"),
            F.round("_age").cast("bigint").alias("seconds_since_update"),
        )
    )


STATE_OPERATORS = "array<struct<numRowsDroppedByWatermark: bigint, customMetrics: map<string, bigint>>>"


def input_rows() -> Column:
    """Source rows of a report."""
    return F.get_json_object("progress", "$.numInputRows").cast("bigint")


def batch_counters(progress: DataFrame) -> DataFrame:
    """Rows that came in, duplicates and late rows that were dropped, by query and batch.

    Batches without input, which only move the watermark, are left out; counters that a query does not
    report are NULL. A batch that was reported twice counts once.
    """
    states = F.from_json(F.get_json_object("progress", "$.stateOperators"), STATE_OPERATORS)
    reported = F.size("_states") > 0
    repeated = F.transform("_states", lambda s: F.try_element_at(s["customMetrics"], F.lit("numDroppedDuplicateRows")))
    late = F.transform("_states", lambda s: F.coalesce(s["numRowsDroppedByWatermark"], F.lit(0)))

    def added(values: Column) -> Column:
        return F.aggregate(values, F.lit(0).cast("bigint"), lambda total, value: total + value)

    rows = (
        progress.withColumn("_states", states)
        .withColumn("input_rows", input_rows())
        .filter(F.col("input_rows") > 0)
        .select(
            "query_name",
            "batch_id",
            "input_rows",
            F.when(reported, added(repeated)).alias("repeated"),
            F.when(reported, added(late)).alias("late"),
        )
    )
    counters = [F.max(c).alias(c) for c in ("input_rows", "repeated", "late")]
    return rows.groupBy("query_name", "batch_id").agg(*counters)


def quality_counters(progress: DataFrame) -> DataFrame:
    """Duplicates and late rows that the latest batch with input of every query dropped; NULL when not reported."""
    newest = Window.partitionBy("query_name").orderBy(F.desc("batch_id"))
    latest = batch_counters(progress).withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1")
    return latest.select(
        "query_name",
        "batch_id",
        F.col("repeated").alias("repeated_events_removed"),
        F.col("late").alias("late_events_removed"),
    )


def stage_throughput(progress: DataFrame) -> DataFrame:
    """Rows per second inside the triggers of each query; empty and repeated batches do not count."""
    millis = F.get_json_object("progress", "$.durationMs.triggerExecution").cast("bigint")
    batches = (
        progress.select("query_name", "batch_id", input_rows().alias("rows"), millis.alias("ms"))
        .filter(F.col("rows") > 0)
        .groupBy("query_name", "batch_id")
        .agg(F.max("rows").alias("rows"), F.max("ms").alias("ms"))
    )
    return batches.groupBy("query_name").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("rows").alias("rows"),
        F.try_divide(F.sum("rows") * F.lit(1000.0), F.sum("ms").cast("double")).alias("rows_per_second"),
    )
