from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from basketline.operators import metrics as M
from basketline.operators.contract import parse_events, valid_events
from basketline.operators.dedup import conflicting_ids, dedup_exact, dedup_stored, require_no_conflicts
from tests.helpers import BASE, brute_metrics, event, metric_dict, random_events, raw_frame


def silver(spark, events):
    return dedup_exact(valid_events(parse_events(raw_frame(spark, events))))


@pytest.mark.parametrize("size,slide", [(60, 60), (300, 60), (120, 60)])
def test_windows_match_brute_force(spark, size, slide):
    events = random_events(500)
    text = (f"{size // 60} minutes", f"{slide // 60} minute")
    frame = silver(spark, events)
    expected = brute_metrics(events, size, slide)
    assert metric_dict(M.window_metrics(frame, *text, users="exact"), M.EXACT_USERS) == expected
    exact = {k: v[:5] for k, v in expected.items()}
    assert metric_dict(M.window_metrics(frame, *text, users=None), None) == exact
    approx = metric_dict(M.window_metrics(frame, *text), "active_users_approx")
    assert {k: v[:5] for k, v in approx.items()} == exact
    assert all(abs(v[5] - expected[k][5]) <= 1 for k, v in approx.items())


def test_money_counts_only_purchases(spark):
    items = [
        event(1, quantity=3, price_paise=19999),
        event(2, quantity=3, price_paise=19999, event_type="purchase"),
    ]
    row = M.window_metrics(silver(spark, items)).first()
    assert (row.events, row.purchases, row.revenue_paise) == (2, 1, 59997)


def test_copies_do_not_inflate(spark):
    assert M.window_rollup(M.window_metrics(silver(spark, [event()] * 100))).first().events == 1


def test_tumbling_edge_is_half_open(spark):
    items = [event(n, BASE + timedelta(seconds=s)) for n, s in enumerate((59, 60))]
    assert [r.events for r in M.window_metrics(silver(spark, items)).collect()] == [1, 1]


def test_one_event_is_in_five_sliding_windows(spark):
    frame = silver(spark, [event(at=BASE + timedelta(seconds=12))])
    assert M.window_metrics(frame, "5 minutes", "1 minute", users=None).count() == 5


def test_sliding_sum_is_five_times_tumbling(spark):
    frame = silver(spark, random_events(300))
    one = M.window_rollup(M.window_metrics(frame, users=None)).first()
    five = M.window_rollup(M.window_metrics(frame, "5 minutes", "1 minute", users=None)).first()
    assert [v * 5 for v in one] == list(five)


def test_snapshot_totals_equal_direct_aggregation(spark):
    frame = silver(spark, random_events(400, users=50))
    row = M.snapshot_totals(frame).first()
    direct = frame.agg(
        F.count("*").alias("n"),
        F.countDistinct("user_id").alias("u"),
        F.approx_count_distinct("user_id", 0.05).alias("a"),
    ).first()
    assert (row.events, row.active_users_exact, row.active_users_approx) == tuple(direct)


def test_totals_of_nothing_are_zero(spark):
    row = M.snapshot_totals(silver(spark, [])).first()
    assert (row.events, row.purchases, row.revenue_paise, row.active_users_exact) == (0, 0, 0, 0)


def test_first_observed_copy_survives(spark):
    frame = raw_frame(spark, [event(price_paise=1), event(price_paise=2)])
    kept = dedup_exact(valid_events(parse_events(frame))).collect()
    assert [r.price_paise for r in kept] == [1]


def test_conflict_audit(spark):
    same = [event(1, event_time="2026-01-01T10:00:00Z"), event(1, event_time="2026-01-01T15:30:00+05:30")]
    other = [event(2), event(2, price_paise=1)]
    audit = conflicting_ids(parse_events(raw_frame(spark, same + other)).filter("valid"))
    assert [(r.event_id, r.payload_variants) for r in audit.collect()] == [("e00002", 2)]
    with pytest.raises(RuntimeError, match="1 event ids"):
        require_no_conflicts(audit)


def test_period_keeps_whole_minutes(spark):
    items = [event(n, BASE + timedelta(minutes=n)) for n in range(20)]
    frame = M.window_metrics(silver(spark, items), users=None)
    at = BASE + timedelta(minutes=19, seconds=40)
    assert M.in_period(frame, 5, at).count() == 6  # the current minute and five before it
    assert M.in_period(frame, None, at).count() == 20


def test_sources_never_mix(spark):
    items = [event(1, product_id="shop:P1"), event(2, product_id="P1")]
    frame = silver(spark, items)
    assert [r.event_id for r in M.from_source(frame, "shop:", True).collect()] == ["e00001"]
    assert [r.event_id for r in M.from_source(frame, "shop:", False).collect()] == ["e00002"]


def test_average_without_purchases_is_unknown(spark):
    frame = M.window_metrics(silver(spark, [event()]), users=None)
    assert M.avg_purchase_value(M.window_rollup(frame)).first().avg_purchase_value is None


def test_ranking_refuses_unknown_measures(spark):
    frame = M.window_metrics(silver(spark, [event()]), users=None)
    with pytest.raises(ValueError):
        M.top_by(frame, "active_users_approx")


@pytest.mark.parametrize("copies,bound", [(0, 10), (7, 10), (7, 3)])
def test_stored_rows_lose_only_later_copies(spark, tmp_path, copies, bound):
    events = random_events(60)
    again = [dict(e, price_paise=77) for e in events[:copies]] * 3
    frame = valid_events(parse_events(raw_frame(spark, events + again)))
    found = dedup_stored(frame, str(tmp_path / "scratch"), broadcast_ids=bound)
    assert sorted((r.event_id, r.offset) for r in found.collect()) == [(e["event_id"], n) for n, e in enumerate(events)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert ("row_number" in plan) == (0 < copies <= bound)  # beyond the bound the result is a table


def test_time_without_date_is_no_instant(spark):
    from basketline.functions.columns import zoned_timestamp

    rows = spark.createDataFrame([("12:30:00Z",), ("T12:30:00Z",), ("2024-03-01T12:30:00Z",), ("2024-03-01 12:30:00+02:00",)], "t string")
    found = [r[0] for r in rows.select(zoned_timestamp(F.col("t"))).collect()]
    assert found[:2] == [None, None] and None not in found[2:]


def test_labels_keep_long_names(spark):
    from basketline.functions.columns import category_label, product_label

    row = spark.createDataFrame([("ns:" + "x" * 5000, "a" * 1_500_000)], "p string, c string")
    label, category = row.select(F.length(product_label(F.col("p"), "ns:", {})), F.length(category_label(F.col("c")))).first()
    assert (label, category) == (5008, 1_500_000)


def test_trending_of_a_paused_source(spark):
    from basketline.operators.metrics import trending

    rows = "window_start timestamp, window_end timestamp, category string, product_id string, views long, purchases long"
    at = lambda m: __import__("datetime").datetime(2024, 1, 1, 0, m)
    table = spark.createDataFrame(
        [(at(1), at(6), "c", "real:a", 3, 0), (at(5), at(10), "c", "b", 9, 1), (at(1), at(6), "c", "b", 8, 1)], rows
    )
    assert [r.product_id for r in trending(table).collect()] == ["b"]
    assert [(r.product_id, r.views) for r in trending(table, namespace="real:", real=True).collect()] == [("real:a", 3)]
