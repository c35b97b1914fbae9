"""Monthly history: CSV files on the way in, validated months on the way out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketline import schemas
from basketline.constants import HISTORY_CSV_FIELDS
from basketline.operators.customers import union_months
from basketline.session import hadoop_path
from basketline.sources.rows import path_prefix, with_source_row


class UnexpectedHeader(ValueError):
    """The CSV header is not exactly the nine fields of the history source."""


def read_history_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Text fields and ``source_row`` of a plain or compressed CSV with the exact header.

    Every file's header is compared by the reader (``enforceSchema`` off). Plain files are split;
    a gzip file is one task, so a large archive should be stored uncompressed or in several files.
    """
    header = spark.read.text(path).limit(1).collect()
    if not header or header[0]["value"].rstrip("\r").split(",") != list(HISTORY_CSV_FIELDS):
        raise UnexpectedHeader(f"unexpected CSV header in {path}")
    rows = (
        spark.read.schema(schemas.HISTORY_CSV)
        .option("header", True)
        .option("enforceSchema", False)
        .option("ignoreCorruptFiles", False)
        .option("multiLine", multi_line)
        .option("escape", '"')
        .csv(path)
    )
    return with_source_row(rows)


def complete_months(spark: SparkSession, root: str) -> list[str]:
    """Names of the months that have a published manifest."""
    pattern, fs = hadoop_path(spark, f"{root}/months/*/manifest/_SUCCESS")
    found = fs.globStatus(pattern) or []
    return sorted(status.getPath().getParent().getParent().getName() for status in found)


def read_months(
    spark: SparkSession, root: str, date_from: str | None = None, date_to: str | None = None
) -> DataFrame:
    """Events of all complete months; the dates prune partitions."""
    months = complete_months(spark, root)
    if not months:
        raise RuntimeError("no validated complete months available")
    # Every month is a partitioned table of its own root, so the months are read one by one.
    reader = spark.read.schema(schemas.HISTORY)
    events = union_months([reader.parquet(f"{root}/months/{m}/events") for m in months])
    if date_from:
        events = events.filter(F.col("event_date") >= date_from)
    if date_to:
        events = events.filter(F.col("event_date") <= date_to)
    return events


def read_prefix(spark: SparkSession, root: str, rows: int) -> DataFrame:
    """The first ``rows`` events in the order of months, dates and files, without sorting them.

    The manifests say which months are read whole; of the one that holds the border only the files up to it are opened.
    """
    parts, left = [], rows
    for manifest in sorted(read_manifests(spark, root).select("month", "accepted_rows").collect()):
        events = f"{root}/months/{manifest['month']}/events"
        if manifest["accepted_rows"] <= left:
            parts.append(spark.read.schema(schemas.HISTORY).parquet(events))
        else:
            parts.append(path_prefix(spark, events, left, schemas.HISTORY))
        left -= manifest["accepted_rows"]
        if left <= 0:
            break
    return union_months(parts)


MANIFEST = schemas.row(
    """
    month string, status string, source_rows bigint, accepted_rows bigint, rejected_rows bigint,
    view_rows bigint, cart_rows bigint, purchase_rows bigint, remove_from_cart_rows bigint,
    first_event_time timestamp, last_event_time timestamp, coverage string, source string, scope string
    """
)


def read_manifests(spark: SparkSession, root: str) -> DataFrame:
    months = complete_months(spark, root)
    return spark.read.schema(MANIFEST).json([f"{root}/months/{m}/manifest" for m in months])
