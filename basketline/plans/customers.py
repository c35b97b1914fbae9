"""Customer report over all complete months of history."""

from __future__ import annotations

import json
import time
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from basketline.operators import customers as K
from basketline.operators import journeys as J
from basketline.operators.reconcile import require_counts
from basketline.session import hadoop_path, path_exists, scratch_folder, through_table
from basketline.sources.history import complete_months, read_manifests, read_months

DEFINITIONS = {
    "conversion": "Customers who bought a product at or after viewing it in the same observed session, "
    "as a share of all distinct viewers of the product.",
    "returning": "Seen in an earlier imported month; says nothing about time before the import.",
    "sessions": "Observed sessions are customer plus session id; inferred ones end after 30 idle minutes.",
    "prices": "Sums of listed prices on purchase records, in source units; not order revenue.",
}


def report_sections(events: DataFrame, folder: str) -> dict[str, DataFrame]:
    """All sections as frames. Customer periods and milestones feed several, so they become tables."""
    periods = through_table(K.customer_periods(events), f"{folder}/customer_periods")
    pairs = through_table(J.journey_pairs(events), f"{folder}/journey_pairs")
    products = K.product_performance(K.product_totals(events), K.matched_buyers(pairs))
    return {
        "monthly": K.period_summary(periods),
        "behaviour": K.customer_behaviour(periods),
        "interests": K.category_interest(events),
        "top_products": K.top_products(products),
        "journeys": J.nest_timelines(J.session_timelines(events)),
        "session_funnel": J.funnel_of_pairs(pairs),
        "timing": J.time_to_purchase(J.view_to_purchase(events, pairs=pairs)),
        "inferred": J.inferred_session_count(J.inferred_sessions(events)),
    }


SINGLE = ("session_funnel", "timing", "inferred")


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small document beside its target and rename it over the old one in one step."""
    fresh, fs = hadoop_path(spark, f"{path}.tmp")
    target, _ = hadoop_path(spark, path)
    stream = fs.create(fresh, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    overwrite = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    overwrite[0] = hadoop.Options.Rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fresh, target, overwrite)


def run_customer_report(spark: SparkSession, root: str) -> dict:
    """Compute, store and return the report. Each section is a table of its own; only bounded
    sections (months, top lists, ten timelines, single rows) are read back for the document."""
    started = time.monotonic()
    events = read_months(spark, root)
    accepted = require_counts(events, read_manifests(spark, root))
    report: dict = {
        "generated_at": datetime.now(timezone.utc).isoformat(),
        "months": complete_months(spark, root),
        "accepted_rows": accepted,
    }
    with scratch_folder(spark) as folder:
        for name, frame in report_sections(K.with_month(events), folder).items():
            table = through_table(frame, f"{root}/report/{name}")
            rows = [row.asDict(recursive=True) for row in table.collect()]
            report[name] = rows[0] if name in SINGLE else rows
    report["monthly"].sort(key=lambda row: row["period"])
    report["behaviour"].sort(key=lambda row: row["period"])
    report["interests"].sort(key=lambda row: (-row["views"], row["category"]))
    report["top_products"].sort(key=lambda row: (-row["views"], row["product_id"]))
    report["journeys"].sort(key=lambda row: (row["user_id"], row["session_id"]))
    report["inferred_30min_sessions"] = report.pop("inferred")["inferred_sessions"]
    report["elapsed_seconds"] = round(time.monotonic() - started, 2)
    report["definitions"] = DEFINITIONS
    replace_text(spark, f"{root}/customer-report.json", json.dumps(report, default=str, indent=2))
    return report


def read_report(spark: SparkSession, root: str) -> dict | None:
    """The published document, if there is one."""
    path = f"{root}/customer-report.json"
    if not path_exists(spark, path):
        return None
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])
