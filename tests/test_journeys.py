import random
from datetime import timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from basketline.operators import customers as K
from basketline.operators import journeys as J
from tests.helpers import BASE

SCHEMA = (
    "event_time timestamp, event_type string, user_id string, session_id string, product_id string, "
    "category string, price_minor bigint, source_row bigint"
)


def history(spark, rows):
    """rows of (seconds, type, user, session, product)"""
    data = [
        (BASE + timedelta(seconds=t), kind, user, session, product, "C" + product[-1], 100, n)
        for n, (t, kind, user, session, product) in enumerate(rows)
    ]
    return spark.createDataFrame(data, SCHEMA)


def random_history(count, seed, hot=True):
    rng = random.Random(seed)
    kinds = ["view", "view", "cart", "purchase", "purchase"]
    rows = []
    for _ in range(count):
        if hot and rng.random() < 0.4:
            rows.append((rng.randrange(5000), rng.choice(kinds), "bot", "s", "p1"))
        else:
            rows.append(
                (rng.randrange(20000), rng.choice(kinds), f"u{rng.randrange(5)}", rng.choice(["a", "b", None]), f"p{rng.randrange(4)}")
            )
    return rows


def brute_first_purchases(rows):
    views, out = {}, {}
    for t, kind, *key in rows:
        if kind == "view" and key[1] is not None:
            views[tuple(key)] = min(t, views.get(tuple(key), t))
    for t, kind, *key in rows:
        key = tuple(key)
        if kind == "purchase" and key in views and t >= views[key]:
            out[key] = min(t, out.get(key, t))
    return {key: out[key] - views[key] for key in out}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_first_purchase_after_first_view(spark, seed):
    rows = random_history(400, seed)
    found = J.view_to_purchase(history(spark, rows)).collect()
    assert {(r.user_id, r.session_id, r.product_id): r.seconds_to_purchase for r in found} == (
        brute_first_purchases(rows)
    )
    assert len(found) == len(brute_first_purchases(rows))


def test_purchase_before_and_after_the_view(spark):
    rows = [(0, "purchase", "u", "s", "p1"), (10, "view", "u", "s", "p1"), (25, "purchase", "u", "s", "p1")]
    row = J.view_to_purchase(history(spark, rows)).first()
    assert row.seconds_to_purchase == 15
    assert J.time_to_purchase(J.view_to_purchase(history(spark, rows))).first().matched_session_products == 1


def test_median_time_is_exact(spark):
    """Many distinct times: the middle one by nearest rank, where an estimate would be off."""
    seconds = F.expr("id * id").alias("seconds_to_purchase")
    row = J.time_to_purchase(spark.range(0, 60_001, 1, 8).select(seconds)).first()
    assert tuple(row) == (60_001, 30_000**2)
    assert tuple(J.time_to_purchase(spark.range(0).select(seconds)).first()) == (0, None)


def brute_visits(rows, gap=1800):
    visits, by_user = [], {}
    for t, _, user, *_ in sorted(rows, key=lambda r: r[0]):
        if user in by_user and t - by_user[user][1] <= gap:
            by_user[user][1] = t
            by_user[user][2] += 1
        else:
            by_user[user] = [t, t, 1]
            visits.append((user, by_user[user]))
    return sorted((user, *v) for user, v in visits)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 40_000), st.sampled_from(["u1", "u2"])), min_size=1, max_size=40))
def test_inferred_visits(spark, items):
    rows = [(t, "view", user, "s", "p1") for t, user in items]
    found = [
        (r.user_id, int((r.session_start - BASE).total_seconds()), int((r.last_action - BASE).total_seconds()), r.actions)
        for r in J.inferred_sessions(history(spark, rows)).collect()
    ]
    assert sorted(found) == brute_visits(rows)


def test_exactly_thirty_minutes_is_one_visit(spark):
    rows = [(0, "view", "u", "s", "p1"), (1800, "view", "u", "s", "p1"), (3601, "view", "u", "s", "p1")]
    assert J.inferred_sessions(history(spark, rows)).count() == 2


def test_inferred_visits_equal_session_windows(spark):
    frame = history(spark, random_history(300, 9))
    windows = frame.groupBy("user_id", F.session_window("event_time", "30 minutes")).count()
    # A session window ends strictly after its gap; the data has no gaps of exactly 30 minutes.
    assert J.inferred_sessions(frame).count() == windows.count()


def test_funnels_use_different_keys(spark):
    rows = [(0, "cart", "u1", "s", "p1"), (5, "purchase", "u2", "s", "p2")]
    frame = history(spark, rows)
    shared = J.cart_funnel(frame.withColumn("session_observed", F.lit(True)), ["session_id"], "event_time", True)
    split = J.cart_funnel(frame, ["user_id", "session_id"], "event_time")
    assert tuple(shared.first()) == (1, 1)
    assert tuple(split.first()) == (1, 0)


def test_unobserved_sessions_are_left_out(spark):
    rows = [(0, "cart", "u1", "s", "p1"), (5, "purchase", "u1", "s", "p1")]
    frame = history(spark, rows).withColumn("session_observed", F.lit(False))
    assert tuple(J.cart_funnel(frame, ["session_id"], "event_time", True).first()) == (0, 0)
    assert J.with_funnel_rate(J.cart_funnel(frame, ["session_id"], "event_time", True)).first().conversion_rate is None


def test_timeline_keeps_count_and_flags_truncation(spark):
    rows = [(n, "view", "u1", "s", "p1") for n in range(250)] + [(3, "cart", "u2", "s", "p1")]
    flat = J.session_timelines(history(spark, rows), sessions=10, cap=200)
    nested = {r.user_id: r for r in J.nest_timelines(flat).collect()}
    assert nested["u1"].total_actions == 250 and nested["u1"].timeline_truncated
    times = [e.event_time for e in nested["u1"].timeline]
    assert len(times) == 200 and times == sorted(times) and times[0] == BASE
    assert nested["u2"].total_actions == 1 and not nested["u2"].timeline_truncated


def test_conversion_counts_people_not_records(spark):
    rows = [
        (0, "view", "u1", "s", "p1"),
        (1, "purchase", "u1", "s", "p1"),
        (2, "purchase", "u1", "s", "p1"),
        (0, "view", "u2", None, "p1"),
        (9, "purchase", "u2", None, "p1"),
        (0, "purchase", "u3", "s", "p2"),
    ]
    frame = history(spark, rows)
    table = K.product_performance(K.product_totals(frame), K.matched_buyers(J.journey_pairs(frame)))
    found = {r.product_id: r for r in table.collect()}
    p1, p2 = found["p1"], found["p2"]
    assert (p1.viewers, p1.purchasers, p1.views, p1.purchases, p1.matched_buyers) == (2, 2, 2, 3, 1)
    assert p1.observed_conversion_pct == 50.0
    assert (p2.viewers, p2.matched_buyers, p2.observed_conversion_pct) == (0, 0, None)
    assert [r.product_id for r in K.rank_products(table, "observed_conversion_pct").collect()] == ["p1", "p2"]


def test_returning_means_seen_in_an_earlier_period(spark):
    frame = history(spark, [(0, "view", "u1", "s", "p1"), (40 * 86400, "purchase", "u1", "s", "p1")] + [
        (40 * 86400 + n, "purchase", "u2", "s", "p1") for n in range(2)
    ])
    periods = K.customer_periods(K.with_month(frame))
    rows = {r.period: r for r in K.customer_behaviour(periods).collect()}
    assert (rows["2026-01"].active_customers, rows["2026-01"].returning_customers) == (1, 0)
    later = rows["2026-02"]
    assert (later.active_customers, later.returning_customers, later.multiple_purchase_record_customers) == (2, 1, 1)
    summary = K.period_summary(periods)
    assert [r.estimated_customers for r in summary.collect()] == [1, 2]
    assert K.history_overview(summary).first().revenue_paise == 300
