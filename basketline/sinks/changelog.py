"""Retry-safe publication of micro-batches, read back as the latest value of every key.

    rows/query_name=<q>/epoch_id=<n>/       absolute values of the keys that changed in an epoch
    commits/query_name=<q>/epoch_id=<n>/    written last: the epoch counts from here on

An epoch is overwritten until it is committed and skipped afterwards, so a new checkpoint needs a new folder.
Rows go from the tasks to the files; nothing passes through the driver.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketline import constants as C
from basketline import schemas
from basketline.session import path_exists

COMMIT = schemas.row("committed_at timestamp, query_name string, epoch_id bigint")
ROWS = T.StructType(
    schemas.WINDOW_METRICS.fields
    + [T.StructField("query_name", T.StringType()), T.StructField("epoch_id", T.LongType())]
)
SERVED = schemas.WINDOW_METRICS.fields + [T.StructField("epoch_id", T.LongType())]


def _folder(root: str, part: str, query_name: str, leaf: str = "") -> str:
    path = f"{root}/{part}/query_name={query_name}"
    return f"{path}/{leaf}" if leaf else path


def committed(spark: SparkSession, root: str, query_name: str, epoch: int) -> bool:
    return path_exists(spark, _folder(root, "commits", query_name, f"epoch_id={epoch}/_SUCCESS"))


def _partition(spark: SparkSession, root: str, part: str, query_name: str, schema: T.StructType) -> DataFrame:
    """One query's epochs; the folders of other queries are not even listed."""
    reader = spark.read.schema(schema).option("basePath", f"{root}/{part}")
    return reader.parquet(_folder(root, part, query_name))


def publish_epoch(frame: DataFrame, epoch: int, query_name: str, root: str) -> bool:
    """Publish the changed keys of one epoch; False when that epoch was committed before.

    A committed epoch is still computed, because a stateful batch has to finish to save its state.
    """
    spark = frame.sparkSession
    if committed(spark, root, query_name, epoch):
        frame.write.format("noop").mode("overwrite").save()
        return False
    leaf = f"epoch_id={epoch}"
    columns = [F.col(f.name).cast(f.dataType) for f in schemas.WINDOW_METRICS.fields]
    frame.select(*columns).write.mode("overwrite").parquet(_folder(root, "rows", query_name, leaf))
    marker = spark.range(1).select(F.current_timestamp().alias("committed_at"))
    marker.coalesce(1).write.mode("overwrite").parquet(_folder(root, "commits", query_name, leaf))
    return True


def epoch_publisher(query_name: str, root: str) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` form."""

    def publish(frame: DataFrame, epoch: int) -> None:
        publish_epoch(frame, epoch, query_name, root)

    return publish


def latest_by_epoch(rows: DataFrame, keys: tuple[str, ...] = ("query_name", *C.METRIC_KEYS)) -> DataFrame:
    """Latest epoch of every key. The rank filter limits each task to one row per key."""
    newest = Window.partitionBy(*keys).orderBy(F.desc("epoch_id"))
    return rows.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1).drop("_rank")


def committed_only(rows: DataFrame, commits: DataFrame) -> DataFrame:
    return rows.join(commits.select("query_name", "epoch_id"), ["query_name", "epoch_id"], "left_semi")


def latest_metrics(spark: SparkSession, root: str, query_name: str) -> DataFrame:
    """The serving table of one query: committed epochs only, the latest value of every key."""
    if not path_exists(spark, _folder(root, "commits", query_name)):
        return spark.createDataFrame([], T.StructType(SERVED))
    rows = _partition(spark, root, "rows", query_name, ROWS)
    commits = _partition(spark, root, "commits", query_name, COMMIT)
    return latest_by_epoch(committed_only(rows, commits).select(*[f.name for f in SERVED]), C.METRIC_KEYS)
