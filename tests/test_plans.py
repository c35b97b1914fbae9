"""What the planner must and must not do, read from the plans themselves."""

import pytest

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"
QUERIES = entry_point.queries()
STREAMS = {name for name in QUERIES if name.startswith("stream_")} | {"pipeline_health", "quality_counters", "stage_throughput"}
BATCH = sorted(set(QUERIES) - STREAMS)


def physical(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_pairwise_joins_and_no_python(spark, name):
    plan = physical(spark, name)
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "ExistingRDD"):
        assert operator not in plan


@pytest.mark.parametrize("name", ["dedup_exact", "upsert_latest_wins", "session_timelines"])
def test_ranks_are_limited_before_the_exchange(spark, name):
    plan = physical(spark, name)
    assert "Partial" in plan and "WindowGroupLimit" in plan


@pytest.mark.parametrize(
    "name", ["category_interest", "top_products", "reservoir_sample", "recent_events", "trending", "session_timelines"]
)
def test_top_lists_do_not_sort_everything(spark, name):
    assert "TakeOrderedAndProject" in physical(spark, name)


@pytest.mark.parametrize(
    "name,columns",
    [
        ("first_observed", {"ts", "user_id", "event_type"}),
        ("snapshot_totals", {"user_id", "event_type", "value", "props"}),
        ("inferred_sessions", {"ts", "user_id", "event_type"}),
    ],
)
def test_scans_read_only_what_is_needed(spark, name, columns):
    plan = physical(spark, name)
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {part.split(":")[0] for part in schema.split(",")} == columns


def test_filters_reach_the_scan(spark):
    assert "Not(EqualTo(event_type,error))" in physical(spark, "snapshot_totals")


@pytest.mark.parametrize("name", ["product_totals", "customer_behaviour", "window_exact_users", "snapshot_totals"])
def test_distinct_counts_do_not_expand_rows(spark, name):
    assert "Expand" not in physical(spark, name)


@pytest.mark.parametrize("name", ["window_tumbling", "journey_pairs", "customer_months"])
def test_sums_are_combined_before_the_exchange(spark, name):
    assert "partial_" in physical(spark, name)
