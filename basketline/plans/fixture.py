"""Exact totals, window metrics and sampling errors of a file of JSON events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketline.operators.contract import parse_events, valid_events
from basketline.operators.dedup import dedup_exact
from basketline.operators.metrics import window_metrics, window_rollup
from basketline.operators.reports import one_row
from basketline.operators.sampling import sample_estimate, with_sampling_error
from basketline.session import scratch_folder, through_table
from basketline.sources.raw import read_json_lines


def fixture_sections(
    spark: SparkSession, path: str, ingested_at: datetime, folder: str
) -> dict[str, DataFrame]:
    """Invalid lines with their reasons, totals with duplicates, sample estimates and windows."""
    parsed = parse_events(read_json_lines(spark, path, ingested_at), strict=True, reasons=True)
    parsed = through_table(parsed, f"{folder}/parsed")
    accepted = valid_events(parsed)
    events = through_table(dedup_exact(accepted), f"{folder}/events")
    windows = window_metrics(events, users="exact")
    lines = parsed.agg(F.count(F.lit(1)).alias("input_lines"), F.count_if("valid").alias("accepted_lines"))
    unique = events.agg(F.count(F.lit(1)).alias("unique_events"))
    totals = one_row(spark, lines=lines, unique=unique, exact=window_rollup(windows)).select(
        "lines.input_lines",
        (F.col("lines.accepted_lines") - F.col("unique.unique_events")).alias("duplicate_records"),
        "exact.events",
        "exact.purchases",
        "exact.revenue_paise",
    )
    refused = parsed.filter(~F.col("valid")).select(F.col("offset").alias("line"), "reject_reason")
    return {
        "invalid_records": refused,
        "totals": totals,
        "sample_estimates": with_sampling_error(sample_estimate(events)),
        "tumbling_windows": windows,
    }


def run_fixture_report(spark: SparkSession, path: str, output: str, ingested_at: datetime) -> None:
    with scratch_folder(spark) as folder:
        for name, frame in fixture_sections(spark, path, ingested_at, folder).items():
            frame.write.mode("overwrite").json(f"{output}/{name}")
