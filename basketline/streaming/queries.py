"""Starting, draining and watching durable streaming queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from basketline.session import ROCKSDB, hadoop_path

AVAILABLE_NOW = {"availableNow": True}


def every(interval: str = "5 seconds") -> dict:
    return {"processingTime": interval}


def start_query(
    df: DataFrame,
    name: str,
    checkpoint_root: str,
    path: str | None = None,
    publish: Callable[[DataFrame, int], None] | None = None,
    mode: str = "append",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Start a named query with its own checkpoint and scheduler pool: to Parquet or to ``publish``."""
    spark = df.sparkSession
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
    writer = (
        df.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", f"{checkpoint_root}/{name}")
        .trigger(**(trigger or every()))
    )
    if publish is not None:
        return writer.foreachBatch(publish).start()
    return writer.format("parquet").option("path", path).start()


def ensure_folder(spark: SparkSession, path: str) -> None:
    """File sources need their folder at start; creating it beats waiting for the upstream query."""
    jpath, fs = hadoop_path(spark, path)
    fs.mkdirs(jpath)


def use_rocksdb(spark: SparkSession) -> None:
    """Keep state off the heap; applies to queries started afterwards."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def require_alive(queries: list[StreamingQuery]) -> None:
    """Fail as soon as any of the queries has died."""
    for query in queries:
        if not query.isActive:
            raise RuntimeError(f"query {query.name} stopped: {query.exception()}")


def drain(queries: list[StreamingQuery]) -> None:
    """Wait for ``availableNow`` queries to finish, and fail if one did not."""
    for query in queries:
        query.awaitTermination()
