import json
from datetime import timedelta

import pytest

from basketline.operators.contract import parse_events, quarantined, split_valid
from tests.helpers import BASE, event, raw_frame


def reasons(spark, events, strict=False, **kwargs):
    parsed = parse_events(raw_frame(spark, events, **kwargs), strict=strict, reasons=True)
    return [(r.valid, r.reject_reason) for r in parsed.orderBy("offset").collect()]


BAD = [
    ({"quantity": True}, "invalid quantity"),
    ({"price_paise": 2.5}, "invalid price_paise"),
    ({"quantity": 0}, "invalid quantity"),
    ({"quantity": 1001}, "invalid quantity"),
    ({"event_type": "refund"}, "invalid event_type"),
    ({"event_id": " "}, "invalid event_id"),
    ({"user_id": "\t\n"}, "invalid user_id"),
    ({"schema_version": 2}, "unsupported schema_version"),
    ({"schema_version": 1.0}, "unsupported schema_version"),
    ({"schema_version": "1"}, "unsupported schema_version"),
    ({"event_type": []}, "invalid event_type"),
    ({"event_time": "2026-01-01T10:00:00"}, "timestamp must include timezone"),
    ({"event_time": "2026"}, "timestamp must include timezone"),
    ({"event_time": "nope"}, "invalid event_time"),
    ({"price_paise": -1}, "invalid price_paise"),
    ({"price_paise": 100_000_001}, "invalid price_paise"),
    ({"category": "x" * 129}, "invalid category"),
    ({"product_id": None}, "invalid product_id"),
]


def test_every_broken_rule_is_named(spark):
    found = reasons(spark, [event(**patch) for patch, _ in BAD])
    assert found == [(False, reason) for _, reason in BAD]


def test_first_failing_rule_wins(spark):
    assert reasons(spark, [event(schema_version=3, quantity=0, event_id="")]) == [
        (False, "unsupported schema_version")
    ]


def test_malformed_records_are_refused_not_thrown(spark):
    found = reasons(spark, ["{bad json", "5", "", None])
    assert [valid for valid, _ in found] == [False] * 4
    assert [reason for _, reason in found][:2] == ["malformed JSON", "event must be a JSON object"]


def test_valid_edges(spark):
    good = [
        event(quantity=1000, price_paise=100_000_000, category="x" * 128),
        event(event_type="remove_from_cart", price_paise=0),
        event(event_time="2026-01-01T10:00:00Z"),
        event(event_time="2026-01-01T15:30:00.123456+05:30"),
    ]
    assert reasons(spark, good) == [(True, None)] * 4


def test_offsets_give_the_same_instant(spark):
    rows = parse_events(
        raw_frame(spark, [event(event_time="2026-01-01T10:00:00Z"), event(event_time="2026-01-01T15:30:00+05:30")])
    ).collect()
    assert rows[0].event_ts == rows[1].event_ts == BASE


def test_future_guard(spark):
    at = [BASE + timedelta(minutes=5), BASE + timedelta(minutes=5, microseconds=1)]
    found = reasons(spark, [event(at=a) for a in at], ingested_at=BASE)
    assert found == [(True, None), (False, "event timestamp too far in the future")]


def test_strict_mode_refuses_cast_ids(spark):
    items = [event(user_id=5), event(session_id={"x": 1}), event()]
    assert [v for v, _ in reasons(spark, items)] == [True, True, True]
    assert reasons(spark, items, strict=True) == [(False, "id is not text")] * 2 + [(True, None)]


def test_split_keeps_every_record_once(spark):
    items = [event(n, quantity=n % 3) for n in range(30)] + ["{broken"]
    parsed = parse_events(raw_frame(spark, items))
    silver, refused = split_valid(parsed)
    assert silver.count() + refused.count() == 31
    assert refused.columns == ["raw_json", "topic", "partition", "offset", "ingested_at"]
    assert "raw_json" not in silver.columns and "valid" not in silver.columns
    payloads = {r.raw_json for r in refused.collect()}
    assert "{broken" in payloads and json.dumps(items[0]) in payloads


def test_documents_are_parsed_once_per_record(spark):
    refused = quarantined(parse_events(raw_frame(spark, [event()]))).select("offset")
    plan = refused._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


@pytest.mark.parametrize("name", ["data_source", "session_observed", "source_row"])
def test_provenance_is_optional(spark, name):
    assert parse_events(raw_frame(spark, [event()])).first()[name] is None
