import csv
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from basketline import constants as C
from basketline.operators import normalize as N
from basketline.operators.reconcile import CountMismatch, count_guard, require_counts
from basketline.plans.customers import read_report, run_customer_report
from basketline.plans.replay import positioned_replay, prepare_replay
from basketline.sinks.history import import_month
from basketline.sources.rows import _bytes, most_splits
from basketline.sources.history import (
    UnexpectedHeader,
    complete_months,
    read_history_csv,
    read_manifests,
    read_months,
)


def row(day="01", kind="view", price="130.76", month="10", user="5001", session="session-a", product="1004", **other):
    values = {
        "event_time": f"2019-{month}-{day} 00:01:46 UTC",
        "event_type": kind,
        "product_id": product,
        "category_id": "20530",
        "category_code": "electronics.smart_phone",
        "brand": "brand",
        "price": price,
        "user_id": user,
        "user_session": session,
        **other,
    }
    return [values[name] for name in C.HISTORY_CSV_FIELDS]


def write_csv(path, rows, header=C.HISTORY_CSV_FIELDS):
    opener = gzip.open if str(path).endswith(".gz") else open
    with opener(path, "wt", newline="", encoding="utf-8") as handle:
        writer = csv.writer(handle)
        writer.writerow(header)
        writer.writerows(rows)
    return str(path)


def rows_frame(spark, rows):
    fields = ", ".join(f"{name} string" for name in C.HISTORY_CSV_FIELDS)
    data = [(*r, n) for n, r in enumerate(rows, 1)]
    return spark.createDataFrame(data, f"{fields}, source_row bigint")


def test_month_is_reconciled_partitioned_and_published_once(spark, tmp_path):
    source = write_csv(tmp_path / "m.csv.gz", [row(), row(kind="purchase"), row(day="02"), row(price="NaN")])
    root = str(tmp_path / "history")
    manifest = import_month(spark, source, "2019-Oct", root, "shop")
    assert (manifest.source_rows, manifest.accepted_rows, manifest.rejected_rows) == (4, 3, 1)
    assert (manifest.view_rows, manifest.purchase_rows) == (2, 1)
    assert "unverified" in manifest.coverage
    parts = [d for d in os.listdir(f"{root}/months/2019-Oct/events") if d.startswith("event_date=")]
    assert sorted(parts) == ["event_date=2019-10-01", "event_date=2019-10-02"]
    refused = spark.read.json(f"{root}/months/2019-Oct/rejected").collect()
    assert [(r.source_row, r.reason, r.record.price) for r in refused] == [(4, "invalid price", "NaN")]
    os.remove(source)  # a published month is not read again
    assert import_month(spark, source, "2019-Oct", root, "shop") == manifest
    events = read_months(spark, root)
    assert events.count() == 3 and complete_months(spark, root) == ["2019-Oct"]
    assert {r.event_id for r in events.collect()} == {f"shop-2019-Oct-row-{n}" for n in (1, 2, 3)}
    assert read_months(spark, root, date_from="2019-10-02").count() == 1
    pruned = read_months(spark, root, date_from="2019-10-02")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in pruned


def test_corrupt_archive_is_never_published(spark, tmp_path):
    path = tmp_path / "m.csv.gz"
    write_csv(path, [row(session=f"s{n}", user=str(n * 7919 % 10007)) for n in range(3000)])
    path.write_bytes(path.read_bytes()[:-2000])
    with pytest.raises(Exception):
        import_month(spark, str(path), "2019-Oct", str(tmp_path / "h"), "shop")
    assert not (tmp_path / "h" / "months").exists()


def test_header_must_match(spark, tmp_path):
    header = list(C.HISTORY_CSV_FIELDS)
    header[6] = "Price"
    path = write_csv(tmp_path / "m.csv", [row()], header)
    with pytest.raises(UnexpectedHeader):
        read_history_csv(spark, path)


def test_month_without_valid_rows_is_refused(spark, tmp_path):
    path = write_csv(tmp_path / "m.csv", [row(price="x")])
    with pytest.raises(ValueError, match="no valid rows"):
        import_month(spark, path, "2019-Oct", str(tmp_path / "h"), "shop")


def test_row_numbers_follow_the_file_across_splits(spark, tmp_path):
    rows = [row(session=f"s{n:06d}") for n in range(1, 5001)]
    path = write_csv(tmp_path / "big month.csv", rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        frame = read_history_csv(spark, path)
        assert frame.rdd.getNumPartitions() > 1
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert 2 <= most_splits(spark.read.text(path)) < 1000
        found = frame.select("source_row", "user_session").collect()
        assert len(found) == 5000
        assert all(r.user_session == f"s{r.source_row:06d}" for r in found)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


BAD_HISTORY = [
    (dict(month="11"), "timestamp outside requested month"),
    (dict(event_time="2019-10-01T00:00:00Z"), "invalid event_time"),
    (dict(event_time="2019-10-32 00:00:00 UTC"), "invalid event_time"),
    (dict(kind="search"), "unsupported event type"),
    (dict(product=""), "missing product_id"),
    (dict(user=""), "missing user_id"),
    *[(dict(price=p), "invalid price") for p in ("NaN", "Infinity", "-1", "1.001", "1000001", "abc", "", "1e-19", "1.00000000000000000001")],
]


def test_history_reject_reasons(spark):
    routed = N.route_history(rows_frame(spark, [row(**c) for c, _ in BAD_HISTORY]), "2019-Oct", "shop")
    found = [r.reason for r in N.rejects(routed).orderBy("source_row").collect()]
    assert found == [reason for _, reason in BAD_HISTORY]


def test_history_defaults_and_exact_prices(spark):
    items = [
        row(session="", brand="", category_code=""),
        row(category_code="", category_id=""),
        row(price=" 7 "),
        row(price="1e3"),
        row(price="1.0000000000000000000000"),
        row(user=" "),
    ]
    accepted, _ = N.normalize_history(rows_frame(spark, items), "2019-Oct", "shop")
    found = accepted.orderBy("source_row").collect()
    assert [r.price_minor for r in found] == [13076, 13076, 700, 100000, 100, 13076]
    assert (found[0].session_id, found[0].brand, found[0].category) == (None, None, "category:20530")
    assert found[1].category == "category:unknown"
    assert found[5].user_id == " "  # blank ids are only refused by the replay rules


def replayable(spark, *rows):
    return N.normalize_replay(rows_frame(spark, list(rows)), "shop:", "shop-oct2019")


def test_replay_fields(spark):
    accepted, _ = replayable(spark, row(kind="purchase", price="12.34", category_code=""), row(session="  ", kind="remove_from_cart"))
    first, second = accepted.orderBy("source_row").collect()
    assert (first.price_paise, first.quantity, first.quantity_observed) == (1234, 1, False)
    assert (first.currency, first.product_id, first.product_name) == ("SOURCE_UNITS", "shop:1004", "1004")
    assert first.category == "category:20530" and first.session_observed
    assert first.source_event_time == first.event_time == "2019-10-01T00:01:46+00:00"
    assert (second.session_id, second.session_observed) == ("shop:missing-row-2", False)
    assert second.event_type == "remove_from_cart" and first.event_id != second.event_id


def test_replay_rejects(spark):
    cases = [dict(price=p) for p in ("NaN", "Infinity", "-1", "1.001", "1000001")]
    cases += [dict(price="abc"), dict(user=" "), dict(category_id=" "), dict(event_time="x")]
    _, refused = replayable(spark, *[row(**c) for c in cases])
    found = [r.reason for r in refused.orderBy("source_row").collect()]
    assert found == ["invalid price precision or range"] * 5 + [
        "invalid price",
        "missing user_id",
        "missing category_id",
        "invalid event_time",
    ]


def test_replayed_events_satisfy_the_live_contract(spark):
    from basketline.operators.contract import parse_events

    accepted, _ = replayable(spark, row(), row(session=""))
    raw = accepted.select(
        F.to_json(F.struct("*")).alias("raw_json"),
        F.lit("t").alias("topic"),
        F.lit(0).alias("partition"),
        F.col("source_row").alias("offset"),
        F.current_timestamp().alias("ingested_at"),
    )
    assert parse_events(raw).filter("valid").count() == 2


def test_replay_cursor_and_repeated_runs(spark):
    table = positioned_replay(rows_frame(spark, [row(), row(price="NaN"), row(), row()]), "shop:", "shop")
    at, cursor, sizes, cursors = "2026-01-01T00:00:00+00:00", 0, [], []
    for _ in range(3):
        piece = N.replay_slice(table, cursor, 2, at=at)
        sizes.append(piece.count())
        cursor = N.next_cursor(piece, cursor)
        cursors.append(cursor)
    assert sizes == [2, 1, 0] and cursors == [2, 3, 3]
    original = N.replay_slice(table, 0, 1, at=at).first()
    again, retry = [N.replay_slice(table, 0, 1, run_id=1, at=at).first() for _ in range(2)]
    assert original.event_id != again.event_id == retry.event_id == "replay-1:" + original.event_id
    assert original.session_id != again.session_id
    assert (original.product_id, original.source_event_time) == (again.product_id, again.source_event_time)
    assert original.event_time == at
    with pytest.raises(ValueError):
        N.replay_slice(table, 0, 1)


def test_prepared_replay_is_kept(spark, tmp_path):
    path = write_csv(tmp_path / "m.csv", [row(), row(price="x"), row(), row()])
    manifest = prepare_replay(spark, path, str(tmp_path / "r"), "shop:", "shop", rows=3)
    assert (manifest.source_rows, manifest.accepted_rows, manifest.rejected_rows) == (3, 2, 1)
    stored = spark.read.parquet(f"{tmp_path}/r/events").orderBy("position").collect()
    assert [(r.position, r.source_row) for r in stored] == [(1, 1), (2, 3)]
    with pytest.raises(FileExistsError):
        prepare_replay(spark, path, str(tmp_path / "r"), "shop:", "shop")


def test_count_guard(spark):
    events = spark.range(3)
    manifests = spark.createDataFrame([(2,), (1,)], "accepted_rows bigint")
    assert require_counts(events, manifests) == 3
    with pytest.raises(CountMismatch):
        require_counts(spark.range(4), manifests)
    assert count_guard(events, manifests.filter("accepted_rows > 5")).first().expected_rows == 0


def test_customer_report(spark, tmp_path):
    root = str(tmp_path / "history")
    october = [
        row(user="1", session="a", product="p1"),
        row(user="1", session="a", product="p1", kind="cart"),
        row(user="1", session="a", product="p1", kind="purchase", price="2.50", event_time="2019-10-01 00:02:46 UTC"),
        row(user="2", session="b", product="p2", day="05"),
    ]
    november = [row(user="1", session="c", product="p2", month="11"), row(price="-3", month="11")]
    for name, rows in (("2019-Oct", october), ("2019-Nov", november)):
        import_month(spark, write_csv(tmp_path / f"{name}.csv", rows), name, root, "shop")
    assert read_report(spark, root) is None
    report = run_customer_report(spark, root)
    assert report["accepted_rows"] == 5 and report["months"] == ["2019-Nov", "2019-Oct"]
    assert [(m["period"], m["customers"], m["purchases"], m["purchase_price_sum"]) for m in report["monthly"]] == [
        ("2019-10", 2, 1, 2.5),
        ("2019-11", 1, 0, 0.0),
    ]
    assert [b["returning_customers"] for b in report["behaviour"]] == [0, 1]
    assert report["session_funnel"] == {"cart_sessions": 1, "converted_sessions": 1}
    assert report["timing"] == {"matched_session_products": 1, "median_seconds_to_purchase": 60}
    assert report["inferred_30min_sessions"] == 3
    assert [(j["user_id"], j["total_actions"]) for j in report["journeys"]] == [("1", 3), ("1", 1), ("2", 1)]
    assert report["top_products"][0]["views"] == 2
    stored = read_report(spark, root)
    assert stored["monthly"] == report["monthly"] and json.dumps(stored["definitions"])
    assert run_customer_report(spark, root)["accepted_rows"] == 5  # replaces the document
    assert read_manifests(spark, root).count() == 2


def test_size_settings():
    assert [_bytes(t) for t in ("40000", "134217728b", "128MB", "4m", "odd")] == [40000, 2**27, 2**27, 2**22, 1]
