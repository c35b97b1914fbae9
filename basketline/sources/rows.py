"""Stable 1-based row numbers of text files that are read in many splits."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketline.session import hadoop_path


BROADCAST_SPLITS = 200_000  # rows of the split table that every task may hold
LISTED_FILES = 10_000  # files whose sizes are looked up


def most_splits(scan: DataFrame) -> float:
    """Upper bound of the number of input splits, from the sizes of the files."""
    spark, files = scan.sparkSession, scan.inputFiles()
    if len(files) > LISTED_FILES:
        return float("inf")
    cost = _bytes(spark.conf.get("spark.sql.files.openCostInBytes"))
    finest = min(cost, _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))
    size = 0
    for name in files:
        path, fs = hadoop_path(spark, spark._jvm.java.net.URI(name))
        size += fs.getFileStatus(path).getLen()
    return size / max(1, finest) + len(files)


def _bytes(text: str) -> int:
    """Bytes of a size setting such as ``134217728b`` or ``128MB``; 1 when it has another form."""
    match = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", text.strip().lower())
    return int(match[1]) * 1024 ** " kmgt".index(match[2] or " ") if match else 1


def with_source_row(scan: DataFrame, name: str = "source_row") -> DataFrame:
    """Number the rows of a file scan in file order. ``scan`` must come straight from a file reader.

    Rows are counted per input split; the number of rows in earlier splits is then added to the
    position inside the split. Only the table of splits (one row per 128 MB or so of input) is put in
    a global order. It is broadcast when the size of the files bounds it, so that the rows themselves
    are not shuffled. Several files are numbered one after the other in the order of their names.
    """
    located = scan.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
    ).withColumn("_id", F.monotonically_increasing_id())
    splits = located.groupBy("_file", "_start").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_id").alias("_first")
    )
    in_order = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select(
        "_file", "_start", "_first", F.coalesce(F.sum("_rows").over(in_order), F.lit(0)).alias("_before")
    )
    if most_splits(scan) <= BROADCAST_SPLITS:
        starts = F.broadcast(starts)
    return (
        located.join(starts, ["_file", "_start"])
        .withColumn(name, (F.col("_before") + F.col("_id") - F.col("_first") + 1).cast("bigint"))
        .drop("_file", "_start", "_id", "_first", "_before")
    )


def path_prefix(spark: SparkSession, path: str, rows: int, schema: T.StructType | None = None) -> DataFrame:
    """The first ``rows`` rows of a Parquet folder, in the order of its paths and of the rows in each file.

    Rows are counted per file, from the footers. Only the files that hold the prefix are opened, and
    only the last of them is cut, by the row numbers it has; nothing is sorted but the table of files.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    counted = reader.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    held = placed.filter(F.col("before") < rows).orderBy("file").collect()
    if not held:
        return reader.parquet(path).limit(0)
    names = [hadoop_path(spark, spark._jvm.java.net.URI(r["file"]))[0].toString() for r in held]
    last = reader.option("basePath", path).parquet(names[-1])
    cut = last.filter(F.col("_metadata.row_index") < rows - held[-1]["before"])
    return reader.option("basePath", path).parquet(*names[:-1]).unionByName(cut) if names[:-1] else cut
