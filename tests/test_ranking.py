import math
import random

import pytest
from pyspark.sql import functions as F

from basketline.functions.ranking import dense_position, nearest_rank


def test_positions_are_dense_across_slices(spark):
    rows = spark.range(0, 1000, 7).repartition(5)
    found = dense_position(rows, "id", slice_rows=50).orderBy("id").collect()
    assert [r.position for r in found] == list(range(1, len(found) + 1))


def nearest(values, p):
    return sorted(values)[max(0, math.ceil(len(values) * p) - 1)]


@pytest.mark.parametrize("slices", [4, 256])
def test_nearest_rank_with_a_dominant_group(spark, slices):
    rng = random.Random(5)
    data = [("hot", rng.choice([1, 1, 1, rng.randrange(500)])) for _ in range(900)]
    data += [(f"g{i % 3}", rng.randrange(50)) for i in range(40)] + [("one", 7), ("gap", None)]
    groups = {}
    for group, value in data:
        if value is not None:
            groups.setdefault(group, []).append(value)
    probabilities = [0.0, 0.01, 0.5, 0.95, 1.0]
    frame = spark.createDataFrame(data, "grp string, v bigint")
    found = nearest_rank(frame, "grp", "v", probabilities, slices=slices).collect()
    assert {(r.grp, r.probability): r.percentile for r in found} == {
        (g, p): nearest(v, p) for g, v in groups.items() for p in probabilities
    }
    assert len(found) == len(groups) * len(probabilities)


def test_no_window_over_raw_rows_without_a_partition(spark):
    numbered = dense_position(spark.range(100).withColumn("x", F.lit(1)), "id", slice_rows=10)
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    # the only unpartitioned window runs on the slice sizes, above their aggregation
    assert plan.count("row_number()") == 1 and "Aggregate [_slice" in plan


def test_null_group_has_percentiles(spark):
    from basketline.functions.ranking import nearest_rank

    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 5), (None, 7), (None, None)], "g string, v int")
    found = {(r.g, r.percentile, r.n) for r in nearest_rank(rows, "g", "v", [0.5]).collect()}
    assert found == {("a", 1, 2), (None, 5, 2)}


def test_null_keys_reconcile(spark):
    from basketline.operators.reconcile import reconcile

    one = spark.createDataFrame([(None, 1), ("a", 2)], "k string, v int")
    assert reconcile(one, one, ["k"], ["v"]).count() == 0
    other = spark.createDataFrame([(None, 3)], "k string, v int")
    assert {(r.k, r.status) for r in reconcile(one, other, ["k"], ["v"]).collect()} == {(None, "different"), ("a", "missing")}


def test_stored_duplicates_with_null_ids(spark, tmp_path):
    from basketline.operators.dedup import dedup_stored

    rows = spark.createDataFrame([(None, 1), (None, 2), ("a", 1), ("a", 2), ("b", 1)], "event_id string, o int")
    both = [dedup_stored(rows, str(tmp_path / str(n)), order_by=["o"], broadcast_ids=n) for n in (0, 10)]
    assert [sorted((r.event_id or "", r.o) for r in f.collect()) for f in both] == [[("", 1), ("a", 1), ("b", 1)]] * 2
