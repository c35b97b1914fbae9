"""The event contract: parse, validate, explain and route raw JSON records.

Everything is a projection or a filter, so it runs unchanged on batch and streaming frames and
adds no shuffle.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketline import constants as C
from basketline import schemas
from basketline.functions.columns import compute_once, has_zone, not_blank, zoned_timestamp


# Rules that need no test of their own for validity: an unparsed instant fails the future guard.
IMPLIED = (C.REASON_TIME, C.REASON_ZONE)


def contract_rules() -> list[tuple[str, Column]]:
    """(reason, condition) pairs in the order in which the first failing rule is reported."""
    rules = [(C.REASON_VERSION, F.col("schema_version") == C.SCHEMA_VERSION)]
    for name in C.REQUIRED_IDS:
        text = F.col(name)
        rules.append((C.REASON_INVALID + name, not_blank(text) & (F.length(text) <= C.MAX_ID_LENGTH)))
    rules.append((C.REASON_INVALID + "event_type", F.col("event_type").isin(*C.EVENT_TYPES)))
    rules.append((C.REASON_INVALID + "quantity", F.col("quantity").between(*C.QUANTITY_RANGE)))
    rules.append((C.REASON_INVALID + "price_paise", F.col("price_paise").between(*C.PRICE_RANGE)))
    rules.append((C.REASON_TIME, F.try_to_timestamp(F.col("event_time")).isNotNull()))
    rules.append((C.REASON_ZONE, has_zone(F.col("event_time"))))
    latest = F.col("ingested_at") + F.expr(f"INTERVAL {C.FUTURE_ALLOWANCE}")
    rules.append((C.REASON_FUTURE, F.col("event_ts") <= latest))
    return rules


def string_kinds_hold(raw_json: Column) -> Column:
    """True when every required id is a JSON string; numbers and objects would be cast to text."""
    document = F.try_parse_json(raw_json)
    kinds = [
        F.schema_of_variant(F.try_variant_get(document, f"$.{name}", "variant")) == "STRING"
        for name in (*C.REQUIRED_IDS, "event_type")
    ]
    held = kinds[0]
    for kind in kinds[1:]:
        held = held & kind
    return held


def reject_reason(strict: bool = False) -> Column:
    """First failing rule of a parsed record, NULL when all hold. An unknown outcome fails.

    A record of which any field was read is an object; only the others are parsed once more to tell why.
    """
    document = F.try_parse_json(F.col("raw_json"))
    unread = reduce(and_, [F.col(f.name).isNull() for f in schemas.EVENT.fields])
    reasons = [
        F.when(unread & document.isNull(), C.REASON_NOT_JSON),
        F.when(unread & ~F.schema_of_variant(document).startswith("OBJECT"), C.REASON_NOT_OBJECT),
    ]
    for reason, holds in contract_rules():
        reasons.append(F.when(~F.coalesce(holds, F.lit(False)), reason))
    if strict:
        reasons.append(F.when(~F.coalesce(string_kinds_hold(F.col("raw_json")), F.lit(False)), "id is not text"))
    return F.when(~F.col("valid"), F.coalesce(*reasons))


def parse_events(raw: DataFrame, strict: bool = False, reasons: bool = False) -> DataFrame:
    """Add the contract fields, ``event_ts`` and ``valid``; with ``reasons`` also ``reject_reason``.

    ``raw`` needs raw_json and ingested_at; all its columns are kept. ``strict`` also refuses ids
    that are JSON numbers, booleans or objects.

    The document is unpacked by a generator rather than field by field: later filters cannot be moved
    below it, so each record is parsed exactly once.
    """
    document = F.from_json("raw_json", schemas.EVENT)
    frame = raw.select("*", F.inline(F.array(document)))
    frame = compute_once(frame, event_ts=zoned_timestamp(F.col("event_time")))
    valid = F.lit(True)
    for reason, holds in contract_rules():
        if reason not in IMPLIED:
            valid = valid & holds
    if strict:
        valid = valid & string_kinds_hold(F.col("raw_json"))
    frame = frame.withColumn("valid", F.coalesce(valid, F.lit(False)))
    return frame.withColumn("reject_reason", reject_reason(strict)) if reasons else frame


def valid_events(parsed: DataFrame) -> DataFrame:
    """Accepted records without the payload text."""
    return parsed.filter("valid").drop("valid", "raw_json", "reject_reason")


def quarantined(parsed: DataFrame) -> DataFrame:
    """Refused records: payload and log coordinates, so that they can be replayed or examined."""
    kept = [f.name for f in schemas.RAW.fields] + (
        ["reject_reason"] if "reject_reason" in parsed.columns else []
    )
    return parsed.filter(~F.col("valid")).select(*kept)


def split_valid(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(silver, quarantine): every record lands in exactly one of the two."""
    return valid_events(parsed), quarantined(parsed)
