"""Compare the published window metrics of a drained pipeline with a recomputation from silver."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketline import constants as C
from basketline.operators.dedup import dedup_stored
from basketline.operators.metrics import window_metrics
from basketline.operators.reconcile import reconcile
from basketline.session import scratch_folder
from basketline.sinks.changelog import latest_metrics
from basketline.sources.raw import scan_silver


class Mismatch(RuntimeError):
    """Published and recomputed metrics differ."""


def metric_mismatches(spark: SparkSession, silver: str, serving: str, folder: str) -> DataFrame:
    """Differing rows of both metric tables, with the query they belong to."""
    events = dedup_stored(scan_silver(spark, silver), folder)
    found = [
        reconcile(
            window_metrics(events, size, slide, users=None), latest_metrics(spark, serving, name)
        ).select(F.lit(name).alias("query_name"), "*")
        for name, size, slide in C.METRIC_WINDOWS
    ]
    return reduce(DataFrame.unionByName, found)


def run_reconciliation(spark: SparkSession, silver: str, serving: str, output: str) -> int:
    """Write the mismatches to ``output``; raises when there are any."""
    with scratch_folder(spark) as folder:
        metric_mismatches(spark, silver, serving, folder).write.mode("overwrite").json(output)
    found = spark.read.text(output).count()
    if found:
        raise Mismatch(f"{found} metric rows differ; see {output}")
    return found
