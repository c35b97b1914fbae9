"""Reports that put several small results into one document, and views of recent records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketline import constants as C
from basketline import schemas
from basketline.functions.columns import category_label, money_label, product_label
from basketline.session import hadoop_path


def one_row(spark, **sections: DataFrame) -> DataFrame:
    """One row with a struct per section. Every section is a one-row frame, read as a scalar subquery."""
    columns = [part.select(F.struct("*").alias(name)).scalar().alias(name) for name, part in sections.items()]
    return spark.range(1).select(*columns)


MEANING = {
    C.REAL_SOURCE: "Real records: listed prices of purchase records are added up; quantities and orders are unknown.",
    C.SYNTHETIC_SOURCE: "Generated records: every purchase is an order of one product.",
}


def batch_report(
    totals: DataFrame, sampling: DataFrame, funnel: DataFrame, conflicts: DataFrame, data_source: str, source: str
) -> DataFrame:
    """Totals, sample estimate, funnel and number of conflicting ids of one snapshot in one row.

    ``source`` says where the events were read; ``definition`` what the sums of this kind of data mean.
    """
    counted = conflicts.agg(F.count(F.lit(1)).alias("conflicting_event_ids"))
    sections = one_row(
        totals.sparkSession, totals=totals, sampling=sampling, session_funnel=funnel, conflicts=counted
    )
    return sections.select(
        F.lit(data_source).alias("data_source"),
        F.lit(source).alias("source"),
        "totals",
        "sampling",
        "session_funnel",
        F.col("conflicts.conflicting_event_ids").alias("conflicting_event_ids"),
        F.lit(MEANING[data_source]).alias("definition"),
    )


def report_json(report: DataFrame, run_id: str) -> DataFrame:
    """(run_id, summary, created_at): the report as one JSON text, as the report table stores it."""
    return report.select(
        F.lit(run_id).alias("run_id"),
        F.to_json(F.struct("*")).alias("summary"),
        F.current_timestamp().alias("created_at"),
    )


def recent_events(raw: DataFrame, data_source: str | None = None, keep: int = 200, show: int = 10) -> DataFrame:
    """The newest ``show`` of the ``keep`` most recent raw records, of one source if given."""
    newest = [F.desc("ingested_at"), F.desc("offset"), F.desc("partition")]
    ring = raw.orderBy(*newest).limit(keep)
    if data_source is not None:
        source = F.coalesce(F.get_json_object("raw_json", "$.data_source"), F.lit(C.SYNTHETIC_SOURCE))
        ring = ring.filter(source == data_source)
    return ring.orderBy(*newest).limit(show)


def write_by_ingestion(raw: DataFrame, path: str, pattern: str = "yyyyMMddHH") -> None:
    """Raw records in a folder per hour of ingestion, or other span that ``pattern`` names, so that the newest can be read alone."""
    rows = raw.withColumn("ingested_in", F.date_format("ingested_at", pattern)).hint("rebalance", "ingested_in")
    rows.write.mode("append").partitionBy("ingested_in").parquet(path)


def newest_ingested(spark: SparkSession, path: str, keep: int = 200) -> DataFrame:
    """The records of the newest folders that hold ``keep`` records or more; older ones are not opened.

    Twice as many folders are looked at until they hold enough; counts come from the files' footers.
    """
    pattern, fs = hadoop_path(spark, f"{path}/ingested_in=*")
    folders = sorted((s.getPath().toString() for s in fs.globStatus(pattern) or []), reverse=True)
    taken = 1
    while True:
        rows = spark.read.schema(schemas.RAW).option("basePath", path).parquet(*folders[:taken])
        if taken >= len(folders) or rows.count() >= keep:
            return rows
        taken *= 2


def display_labels(
    df: DataFrame, namespace: str, names: dict[str, str] | None = None, money: str | None = None, symbol: str = ""
) -> DataFrame:
    """Readable product and category names beside the ids; ``money`` names a column of minor units."""
    labels = {
        "product_label": product_label(F.col("product_id"), namespace, names),
        "category_label": category_label(F.col("category")),
    }
    if money:
        labels["money_label"] = money_label(F.col(money), symbol)
    return df.withColumns(labels)
