import hashlib

import pytest
from pyspark.sql import functions as F

from basketline.operators import sampling as S
from basketline.operators import sketches as B
from tests.helpers import event, random_events, raw_frame


def counted(spark, counts):
    return spark.createDataFrame([(k,) for k, n in counts.items() for _ in range(n)], "k string")


def test_shapes():
    assert B.cms_shape() == (272, 5)
    assert B.bloom_shape(5000) == (47926, 7)
    for wrong in ((0, 0.1), (0.1, 1)):
        with pytest.raises(ValueError):
            B.cms_shape(*wrong)
    with pytest.raises(ValueError):
        B.bloom_shape(0)


def test_count_min_never_undercounts(spark):
    counts = {"a": 71, "b": 12, "c": 5}
    rows = counted(spark, counts)
    sketch = B.cms_build(rows, "k")
    assert B.cms_total(sketch).first().total == 88
    found = {r.k: r.estimate for r in B.cms_estimate(sketch, rows.distinct(), "k").collect()}
    assert all(found[k] >= n for k, n in counts.items())


def test_collisions_overcount_within_the_bound(spark):
    rows = spark.range(4000).select((F.col("id") % 900).cast("string").alias("k"))
    table = B.cms_comparison(rows, "k", k=900, epsilon=0.05)
    found = table.collect()
    assert len(found) == 900 and all(r.overcount >= 0 for r in found)
    assert any(r.overcount > 0 for r in found)
    assert sum(r.overcount > 0.05 * 4000 for r in found) <= 9


def test_merged_sketch_equals_sketch_of_everything(spark):
    rows = spark.range(500).select((F.col("id") % 40).cast("string").alias("k"))
    parts = [rows.filter(F.col("k") < "2"), rows.filter(F.col("k") >= "2")]
    merged = B.cms_merge(*[B.cms_build(p, "k") for p in parts])
    assert merged.exceptAll(B.cms_build(rows, "k")).count() == 0
    assert merged.count() == B.cms_build(rows, "k").count()


def test_unknown_key_without_collision_is_zero(spark):
    sketch = B.cms_build(counted(spark, {"a": 3}), "k")
    keys = spark.createDataFrame([("zzz",)], "k string")
    assert B.cms_estimate(sketch, keys, "k").first().estimate == 0


@pytest.mark.parametrize("capacity", [1000, 3_000_000])
def test_bloom_has_no_false_negatives(spark, capacity):
    inserted = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    absent = spark.range(1000, 2000).select(F.col("id").cast("string").alias("k"))
    bits = B.bloom_build(inserted, "k", capacity)
    assert B.bloom_contains(bits, inserted, "k", capacity).filter("not maybe_present").count() == 0
    report = B.bloom_report(B.bloom_contains(bits, absent, "k", capacity)).first()
    assert report.absent_probes == 1000 and report.false_positives < 50


def test_uniform_sample(spark):
    rows = spark.range(1000).select(F.col("id").cast("string").alias("event_id"))
    first = {r.event_id for r in S.uniform_sample(rows, 10).collect()}
    again = {r.event_id for r in S.uniform_sample(rows.repartition(7), 10).collect()}
    assert first == again and len(first) == 10
    assert any(int(x) >= 10 for x in first)
    assert first != {r.event_id for r in S.uniform_sample(rows, 10, seed=1).collect()}


def test_hash_sample_is_stable_nested_and_the_documented_bucket(spark):
    rows = spark.range(2000).select(F.col("id").cast("string").alias("event_id"))

    def members(fraction):
        return {r.event_id for r in S.hash_sample(rows, fraction).collect()}

    expected = {str(i) for i in range(2000) if int(hashlib.sha256(str(i).encode()).hexdigest()[:8], 16) / 2**32 < 0.1}
    assert members(0.1) == expected
    assert members(0.05) <= members(0.1) <= members(0.5)
    assert len(members(1)) == 2000
    for wrong in (0, 1.5):
        with pytest.raises(ValueError):
            S.hash_sample(rows, wrong)


def test_estimates_at_full_fraction_are_exact(spark):
    from basketline.operators.contract import parse_events, valid_events

    frame = valid_events(parse_events(raw_frame(spark, random_events(200))))
    rows = {r.fraction: r for r in S.with_sampling_error(S.sample_estimate(frame)).collect()}
    full = rows[1.0]
    assert full.sample_count == 200 and full.event_relative_error == 0 and full.revenue_relative_error == 0
    assert rows[0.5].estimated_events == rows[0.5].sample_count / 0.5
    empty = valid_events(parse_events(raw_frame(spark, [event(quantity=0)])))
    assert S.with_sampling_error(S.sample_estimate(empty, [0.1])).first().event_relative_error is None
