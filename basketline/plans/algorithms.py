"""Sketch experiment on history: how far Count-Min, Bloom and a uniform sample are from the truth."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketline import constants as C
from basketline.operators import sketches
from basketline.operators.sampling import uniform_sample
from basketline.plans.customers import replace_text
from basketline.session import path_exists, scratch_folder, through_table
from basketline.sources.history import read_months, read_prefix

SCOPE = "All records of the imported months, or the first in path order where a limit was asked for."
DEFINITIONS = {
    "count_min_sketch": "Exact counts choose the compared keys; this is a check, not a bounded-memory tracker.",
    "reservoir": "Uniform sample without replacement over the experiment's records.",
    "bloom": "Probes are record ids that were never inserted. Never used to discard events.",
}


def experiment_records(spark: SparkSession, root: str, limit: int | None = None) -> DataFrame:
    """The records, or the first ``limit`` in path order, with only the columns the experiment reads."""
    events = read_months(spark, root) if limit is None else read_prefix(spark, root, limit)
    return events.select("event_time", "source_row", "event_id", "product_id")


def experiment_sections(records: DataFrame, inserted: int, sample: int) -> dict[str, DataFrame]:
    """Sketches of a stored table of records; the first ``inserted`` fill the Bloom filter."""
    first = records.orderBy("event_time", "source_row", "event_id").limit(inserted).select("event_id")
    others = records.select("event_id").join(first, "event_id", "left_anti")
    bits = sketches.bloom_build(first, "event_id", inserted)
    return {
        "count_min_sketch": sketches.cms_comparison(records, "product_id"),
        "reservoir": uniform_sample(records, sample).select("event_id", "product_id"),
        "bloom": sketches.bloom_report(sketches.bloom_contains(bits, others, "event_id", inserted)),
    }


def run_algorithm_report(
    spark: SparkSession, root: str, limit: int | None = None, inserted: int = 5000, sample: int = 1000
) -> dict:
    """Run the experiment on imported history and publish its report beside the customer report.

    All records take part unless a ``limit`` is asked for; ``inserted`` and ``sample`` bound what is
    read back.
    """
    records = experiment_records(spark, root, limit)
    with scratch_folder(spark) as folder:
        records = through_table(records, f"{folder}/records")
        seen = records.count()
        inserted = min(inserted, seen)
        parts = {k: f.collect() for k, f in experiment_sections(records, inserted, sample).items()}
    width, depth = sketches.cms_shape()
    bits, _ = sketches.bloom_shape(inserted)
    report = {
        "scope": SCOPE,
        "events": seen,
        "count_min_sketch": {
            "width": width,
            "depth": depth,
            "comparison": sorted((r.asDict() for r in parts["count_min_sketch"]), key=lambda r: -r["exact"]),
        },
        "reservoir": {
            "seen": seen,
            "size_limit": sample,
            "retained": len(parts["reservoir"]),
            "seed": C.SAMPLE_SEED,
            "examples": [r.asDict() for r in parts["reservoir"][:10]],
        },
        "bloom": {"inserted": inserted, "bit_array_bytes": (bits + 7) // 8, **parts["bloom"][0].asDict()},
        "definitions": DEFINITIONS,
    }
    replace_text(spark, f"{root}/algorithm-report.json", json.dumps(report, indent=2))
    return report


def read_algorithm_report(spark: SparkSession, root: str) -> dict | None:
    path = f"{root}/algorithm-report.json"
    if not path_exists(spark, path):
        return None
    return json.loads(spark.read.text(path, wholetext=True).first()["value"])
