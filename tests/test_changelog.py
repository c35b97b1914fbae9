from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from basketline import constants as C
from basketline.operators.reconcile import reconcile
from basketline.sinks import changelog as L
from tests.helpers import BASE


def metrics(spark, revenue=19999, products=("P1",), fail=False):
    rows = [(BASE, BASE + timedelta(minutes=1), "Home", p, 2, 1, revenue, 1, 0, 1) for p in products]
    frame = spark.createDataFrame(
        rows,
        "window_start timestamp, window_end timestamp, category string, product_id string, events bigint, "
        "purchases bigint, revenue_paise bigint, views bigint, carts bigint, active_users_approx bigint",
    )
    if fail:
        broken = F.when(F.col("product_id") != "", F.raise_error(F.lit("injected failure")))
        frame = frame.withColumn("views", broken.cast("bigint"))
    return frame


def read(spark, root, name="test"):
    return sorted((r.product_id, r.revenue_paise, r.epoch_id) for r in L.latest_metrics(spark, root, name).collect())


def test_retry_is_a_no_op_and_values_are_absolute(spark, tmp_path):
    root = str(tmp_path)
    assert L.publish_epoch(metrics(spark), 0, "test", root)
    assert not L.publish_epoch(metrics(spark, 5), 0, "test", root)
    assert read(spark, root) == [("P1", 19999, 0)]
    assert L.publish_epoch(metrics(spark, 39998), 1, "test", root)
    assert not L.publish_epoch(metrics(spark), 0, "test", root)
    assert read(spark, root) == [("P1", 39998, 1)]


def test_failed_epoch_leaves_nothing_and_can_be_retried(spark, tmp_path):
    root = str(tmp_path)
    with pytest.raises(Exception, match="injected failure"):
        L.publish_epoch(metrics(spark, fail=True), 0, "test", root)
    assert read(spark, root) == []
    assert L.publish_epoch(metrics(spark), 0, "test", root)
    assert read(spark, root) == [("P1", 19999, 0)]


def test_rows_without_a_commit_are_invisible(spark, tmp_path):
    root = str(tmp_path)
    L.publish_epoch(metrics(spark), 0, "test", root)
    metrics(spark, 1).write.parquet(f"{root}/rows/query_name=test/epoch_id=1")  # crash before the marker
    assert read(spark, root) == [("P1", 19999, 0)]
    assert L.publish_epoch(metrics(spark, 7), 1, "test", root)
    assert read(spark, root) == [("P1", 7, 1)]


def test_queries_are_separate_and_unknown_ones_empty(spark, tmp_path):
    root = str(tmp_path)
    L.publish_epoch(metrics(spark, 1), 0, "one", root)
    L.publish_epoch(metrics(spark, 2), 5, "two", root)
    assert read(spark, root, "one") == [("P1", 1, 0)]
    assert read(spark, root, "two") == [("P1", 2, 5)]
    assert read(spark, root, "three") == []


def test_empty_epoch_is_committed(spark, tmp_path):
    root = str(tmp_path)
    assert L.publish_epoch(metrics(spark, products=()), 0, "test", root)
    assert read(spark, root) == [] and L.committed(spark, root, "test", 0)


def test_reconcile_reports_all_kinds_of_difference(spark):
    expected = metrics(spark, 1, ("same", "changed", "gone"))
    actual = metrics(spark, 1, ("same",)).unionByName(metrics(spark, 2, ("changed", "new")))
    found = {r.product_id: r for r in reconcile(expected, actual).collect()}
    assert {k: r.status for k, r in found.items()} == {"changed": "different", "gone": "missing", "new": "unexpected"}
    assert (found["changed"].expected_revenue_paise, found["changed"].actual_revenue_paise) == (1, 2)
    assert found["gone"].actual_events is None
    assert reconcile(expected, expected, C.METRIC_KEYS).count() == 0
