"""Stored layouts: what is read again, moved again or written again, and what is not."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from basketline.operators import customers, journeys, metrics, quantiles, reports, sketches
from basketline.operators.contract import parse_events, valid_events
from basketline.sinks.history import republish_dates, write_by_customer, write_by_date
from basketline.sources.rows import path_prefix
from tests.helpers import BASE, event, random_events, raw_frame
from workload import views as V

SF = "/root/testdata/sf0.001"


def files(frame):
    return {name.rsplit("/", 1)[1] for name in frame.inputFiles()}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_prefix_opens_only_the_files_that_hold_it(spark, tmp_path):
    folder = str(tmp_path / "rows with space")
    spark.range(1000).repartitionByRange(10, "id").sortWithinPartitions("id").write.parquet(folder)
    for n in (0, 150, 1000, 5000):
        found = path_prefix(spark, folder, n)
        assert sorted(r.id for r in found.collect()) == list(range(min(n, 1000)))
    assert len(files(path_prefix(spark, folder, 150))) == 2 and "Sort" not in plan(path_prefix(spark, folder, 150))


def test_newest_folders_leave_older_files_closed(spark, tmp_path):
    folder = str(tmp_path / "bronze")
    raw = V.raw(spark, SF)
    reports.write_by_ingestion(raw, folder, "yyyyMMdd")
    newest = reports.newest_ingested(spark, folder, 200)
    assert newest.count() >= 200 and len(newest.inputFiles()) < len(spark.read.parquet(folder).inputFiles()) / 2
    oldest = newest.agg(F.min("ingested_at")).first()[0]
    assert raw.filter(F.col("ingested_at") > oldest).count() < newest.count() + 1
    assert reports.newest_ingested(spark, folder, 10**9).count() == raw.count()


def test_single_dates_are_published_again(spark, tmp_path):
    folder = str(tmp_path / "events")
    rows = spark.createDataFrame([(i, f"2024-01-0{i % 3 + 1}") for i in range(30)], "id long, event_date string")
    write_by_date(rows, folder)
    kept = {p: os.path.getmtime(p) for d in ("event_date=2024-01-01", "event_date=2024-01-03") for p in [f"{folder}/{d}"]}
    republish_dates(spark.createDataFrame([(99, "2024-01-02")], rows.schema), folder)
    found = spark.read.schema(rows.schema).parquet(folder)
    assert sorted(r.id for r in found.collect()) == sorted([i for i in range(30) if i % 3 != 1] + [99])
    assert all(os.path.getmtime(p) == t for p, t in kept.items())


def test_events_by_customer_need_no_exchange(spark, tmp_path):
    history = V.history(spark, SF)
    stored = write_by_customer(history, str(tmp_path / "b"), "events_by_customer", 4)
    try:
        for build in (customers.customer_periods, journeys.journey_pairs, customers.with_first_observed):
            frame = build(customers.customer_periods(stored)) if build is customers.with_first_observed else build(stored)
            assert "Exchange" not in plan(frame)
        assert "Exchange" in plan(customers.customer_periods(history))
        assert customers.customer_periods(stored).exceptAll(customers.customer_periods(history)).count() == 0
    finally:
        spark.sql("DROP TABLE events_by_customer")


def test_merged_sketches_count_users_once(spark):
    frame = valid_events(parse_events(raw_frame(spark, random_events(300, users=40))))
    stored = metrics.user_sketches(frame, ["category"])
    merged = metrics.merge_users(stored).first()[0]
    exact = frame.select("user_id").distinct().count()
    assert abs(merged - exact) <= max(1, 0.2 * exact)
    assert stored.count() < 300
    assert metrics.merge_users(stored.limit(0)).first()[0] in (0, None)


def test_sliding_estimates_do_not_copy_events(spark):
    frame = V.silver(spark, SF)
    found = metrics.window_metrics(frame, "5 minutes", "1 minute")
    assert plan(found).count("Expand") == 1 and "hll_union_agg" in plan(found).lower()
    exact = metrics.window_metrics(frame, "5 minutes", "1 minute", users="exact")
    keys = ["window_start", "window_end", "category", "product_id"]
    both = exact.join(found.drop("events", "purchases", "revenue_paise", "views", "carts"), keys)
    assert both.count() == exact.count() == found.count()
    assert both.filter(~metrics.estimate_in_bound("active_users_exact", "active_users_approx")).count() == 0


def test_quantile_sketches_merge(spark):
    rows = spark.range(20000).select((F.col("id") % 7).alias("k"), (F.col("id") % 50).alias("day"), (F.col("id") * 7919 % 10007).alias("v"))
    daily = quantiles.value_sketches(rows, ["k", "day"], "v")
    found = quantiles.quantiles(quantiles.merge_sketches(daily, ["k"]), [0.0, 0.25, 0.5, 0.99, 1.0])
    checked = quantiles.rank_checked(found, rows, ["k"], "v").collect()
    assert len(checked) == 35 and all(r.within_bound for r in checked)
    assert {r.k: r.n for r in checked} == {r.k: r.n for r in rows.groupBy("k").agg(F.count("v").alias("n")).collect()}
    wrong = quantiles.rank_checked(found.withColumn("quantile", F.lit(0).cast("bigint")), rows, ["k"], "v").filter("probability = 0.5")
    assert not any(r.within_bound for r in wrong.collect())


def test_merged_filters_hold_both_sides(spark):
    left, right = (spark.range(a, b).select(F.col("id").cast("string").alias("k")) for a, b in ((0, 400), (400, 900)))
    both = sketches.bloom_merge(*[sketches.bloom_build(x, "k", 60_000) for x in (left, right)])
    whole = sketches.bloom_build(left.unionByName(right), "k", 60_000)
    assert {(r.bucket, bytes(r.bits)) for r in both.collect()} == {(r.bucket, bytes(r.bits)) for r in whole.collect()}
    asked = sketches.bloom_contains(both, left.unionByName(right), "k", 60_000)
    assert asked.filter("not maybe_present").count() == 0 and asked.count() == 900
    nothing = spark.createDataFrame([(None,)], "k string")
    assert not sketches.bloom_contains(both, nothing, "k", 60_000).first().maybe_present
    # One row of the join per probe, whatever the number of hashes.
    assert "Generate" not in plan(sketches.bloom_contains(spark.createDataFrame(both.collect(), both.schema), left, "k", 60_000))


def test_one_parse_finds_conflicts(spark):
    from basketline.operators.dedup import conflicting_ids

    events = [event(n) for n in range(5)] + [event(1, price_paise=5), event(1, price_paise=6), event(1, price_paise=5), event(2)]
    found = conflicting_ids(parse_events(raw_frame(spark, events)).filter("valid"))
    assert plan(found).count("from_json") == 1
    assert [tuple(r) for r in found.collect()] == [("e00001", 3)]


def test_periods_in_one_pass(spark):
    from datetime import timedelta

    items = [event(n, BASE + timedelta(minutes=n), product_id="shop:P" if n % 2 else "P") for n in range(40)]
    rows = metrics.window_metrics(valid_events(parse_events(raw_frame(spark, items))), users=None)
    periods = {"all": None, "five": 5, "thirty": 30}
    for real in (True, False):
        got = {r.period: r.events for r in metrics.period_totals_each(rows, periods, "shop:", real).collect()}
        want = {name: metrics.period_totals(rows, length, BASE + timedelta(minutes=39), "shop:", real).first().events for name, length in periods.items()}
        assert got == want
    empty = metrics.period_totals_each(rows.limit(0), periods, "shop:")
    assert [r.events for r in empty.collect()] == [0, 0, 0]


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_rows_of_several_files_are_numbered_without_a_sort(spark, tmp_path, compression):
    from basketline.sources.history import read_history_csv
    from workload.queries import _csv_files

    rows = read_history_csv(spark, _csv_files(spark, SF, str(tmp_path / "csv"), compression))
    numbers = [r.source_row for r in rows.select("source_row").collect()]
    assert sorted(numbers) == list(range(1, len(numbers) + 1))
    assert "SortMergeJoin" not in plan(rows) and "BroadcastHashJoin" in plan(rows)


def test_json_lines_are_numbered_in_order_over_any_number_of_files(spark, tmp_path, monkeypatch):
    from workload import queries as W

    rows = [(n * 7919 % 1000, datetime(2024, 1, 1), n % 5, ("view", "click", "error")[n % 3], 1.5, '{"k": 3}') for n in range(1000)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    events.write.parquet(str(tmp_path / "events.parquet"))
    raw = V.raw_bad(spark, str(tmp_path)).withColumn("ingested_at", F.lit(datetime(2025, 1, 1)))
    expected = [(n, r.valid) for n, r in enumerate(parse_events(raw).orderBy("offset").select("valid").collect(), 1)]
    for size, least in ((250_000, 2), (100, 8)):
        monkeypatch.setattr(W, "LINES_A_FILE", size, raising=False)
        monkeypatch.setattr(W, "shared_folder", lambda _, size=size: str(tmp_path / f"lines{size}"))
        found = W.json_lines(spark, str(tmp_path))
        assert sorted((r.line, r.valid) for r in found.collect()) == expected
        assert len([p for p in (tmp_path / f"lines{size}").glob("part-*") if p.stat().st_size]) >= least
