"""Raw records from a log, from files of raw records, or from JSON lines."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketline import schemas
from basketline.sources.rows import with_source_row


def kafka_options(bootstrap: str, topic: str, max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Options of the log source: from the start, missing offsets are an error, input capped if asked."""
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def raw_from_log(log: DataFrame) -> DataFrame:
    """The five raw columns of a log source; its own timestamp is the time of ingestion."""
    return log.select(
        F.col("value").cast("string").alias("raw_json"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("ingested_at"),
    )


def read_raw(spark: SparkSession, kind: str, options: dict[str, str]) -> DataFrame:
    """Streaming raw records: ``kafka`` with its options, or ``files`` with ``path``."""
    if kind == "kafka":
        return raw_from_log(spark.readStream.format("kafka").options(**options).load())
    if kind == "files":
        return stream_files(spark, schemas.RAW, **options)
    raise ValueError(f"unknown raw source {kind}")


def stream_files(
    spark: SparkSession, schema: T.StructType, path: str, max_files_per_trigger: int | str | None = None
) -> DataFrame:
    """Parquet files as a stream, with the schema given rather than inferred."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(path)


def scan_silver(spark: SparkSession, path: str, merge: bool = False) -> DataFrame:
    """Stored valid events. ``merge`` reads files written before optional columns existed."""
    if merge:
        return spark.read.option("mergeSchema", "true").parquet(path)
    return spark.read.schema(schemas.SILVER).parquet(path)


def read_json_lines(spark: SparkSession, path: str, ingested_at: datetime) -> DataFrame:
    """JSON lines as raw records; the line number is the offset."""
    lines = with_source_row(spark.read.text(path), "offset")
    return lines.select(
        F.col("value").alias("raw_json"),
        F.lit("file").alias("topic"),
        F.lit(0).alias("partition"),
        "offset",
        F.lit(ingested_at).cast("timestamp").alias("ingested_at"),
    )
