"""Snapshot report over stored valid events: windows, totals, sample estimate, funnel, conflicts."""

from __future__ import annotations

import uuid

from pyspark.sql import Row, SparkSession

from basketline.operators.contract import parse_events
from basketline.operators.dedup import ConflictingPayloads, conflicting_ids, dedup_stored
from basketline.operators.journeys import cart_funnel
from basketline.operators.metrics import analysis_clock, from_source, snapshot_totals, window_metrics
from basketline.operators.reports import batch_report, report_json
from basketline.operators.sampling import sample_estimate
from basketline.session import path_exists, scratch_folder
from basketline.sources.raw import scan_silver


def audit_conflicts(spark: SparkSession, bronze: str, output: str):
    """Write the ids with contradictory payloads and fail if there are any."""
    path = f"{output}/conflicting_ids"
    raw = spark.read.parquet(bronze)
    conflicting_ids(parse_events(raw).filter("valid")).write.mode("overwrite").parquet(path)
    conflicts = spark.read.parquet(path)
    found = conflicts.count()
    if found:
        raise ConflictingPayloads(f"{found} event ids have conflicting payloads; see {path}")
    return conflicts


def run_snapshot(
    spark: SparkSession,
    silver: str,
    output: str,
    namespace: str,
    real: bool = False,
    sample_fraction: float = 0.1,
    bronze: str | None = None,
    run_id: str | None = None,
) -> Row:
    """Compute the report of one source, write every section below ``output`` and return the report row.

    De-duplication comes first and is paid once; the sections then scan only the columns they need.
    """
    with scratch_folder(spark) as folder:
        return _run(spark, folder, silver, output, namespace, real, sample_fraction, bronze, run_id)


def _run(spark, folder, silver, output, namespace, real, sample_fraction, bronze, run_id) -> Row:
    if bronze and path_exists(spark, bronze):
        conflicts = audit_conflicts(spark, bronze, output)
    else:
        conflicts = spark.createDataFrame([], "event_id string, payload_variants bigint")
    stored = from_source(scan_silver(spark, silver, merge=True), namespace, real)
    events = dedup_stored(stored, folder)
    window_metrics(events).write.mode("overwrite").parquet(f"{output}/windows")
    sections = {
        "totals": snapshot_totals(events),
        "sampling": sample_estimate(events, [sample_fraction]).drop("exact_events", "exact_revenue_paise"),
        "session_funnel": cart_funnel(
            analysis_clock(events, real), ["session_id"], "analysis_ts", observed_only=True
        ),
    }
    stored_sections = {}
    for name, frame in sections.items():
        frame.write.mode("overwrite").json(f"{output}/{name}")
        stored_sections[name] = spark.read.schema(frame.schema).json(f"{output}/{name}")
    report = batch_report(
        stored_sections["totals"],
        stored_sections["sampling"],
        stored_sections["session_funnel"],
        conflicts,
        "real" if real else "synthetic",
        silver,
    )
    row = report_json(report, run_id or str(uuid.uuid4()))
    row.write.mode("append").json(f"{output}/reports")
    return report.first()
