"""Turn the text rows of a monthly history file into history events or replayable live events.

Both normalisers take the nine text fields plus ``source_row`` and keep every row: rejected ones
carry ``reject_reason``. They are projections, so one pass over the file feeds both outcomes.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketline import constants as C
from basketline import schemas
from basketline.functions.columns import (
    compute_once,
    empty_to_null,
    exact_minor_units,
    history_timestamp,
    is_number,
    iso_utc,
    not_blank,
    strip,
)

HISTORY_FIELDS = [f.name for f in schemas.HISTORY.fields]
REPLAY_FIELDS = [f.name for f in schemas.EVENT.fields]


def _first_reason(rules: list[tuple[str, Column]]) -> Column:
    """Reason of the first rule that does not hold; an unknown outcome does not hold."""
    return F.coalesce(*[F.when(~F.coalesce(holds, F.lit(False)), reason) for reason, holds in rules])


def _record() -> Column:
    return F.struct(*C.HISTORY_CSV_FIELDS)


def _category() -> Column:
    """Category code, or the id marked as such, or ``category:unknown``."""
    code = empty_to_null(F.col("category_code"))
    number = F.coalesce(empty_to_null(F.col("category_id")), F.lit(C.UNKNOWN_CATEGORY))
    return F.coalesce(code, F.concat(F.lit(C.CATEGORY_PREFIX), number))


def _measured(rows: DataFrame) -> DataFrame:
    """Parse time and price once; most rules and outputs use them."""
    return compute_once(
        rows, _at=history_timestamp(F.col("event_time")), _minor=exact_minor_units(F.col("price"))
    )


def month_bounds(month: str) -> tuple[Column, Column]:
    """First instants of a month such as ``2019-Oct`` and of the month after it, in UTC."""
    first = datetime.strptime(month, C.MONTH_FORMAT)
    following = (first + timedelta(days=31)).replace(day=1)
    return tuple(F.lit(f"{day:%Y-%m-%d}T00:00:00Z").cast("timestamp") for day in (first, following))


def route_history(rows: DataFrame, month: str, id_prefix: str) -> DataFrame:
    """History columns, ``reject_reason`` and the original ``record`` for every source row.

    ``month`` looks like ``2019-Oct``. Empty product and customer ids are refused, blank ones are not.
    """
    rows = _measured(rows)
    at, price = F.col("_at"), F.col("_minor")
    first, following = month_bounds(month)
    rules = [
        (C.REASON_TIME, at.isNotNull()),
        (C.REASON_MONTH, (at >= first) & (at < following)),
        (C.REASON_TYPE, F.col("event_type").isin(*C.HISTORY_EVENT_TYPES)),
        (C.REASON_MISSING + "product_id", F.col("product_id") != ""),
        (C.REASON_MISSING + "user_id", F.col("user_id") != ""),
        (C.REASON_PRICE, price.isNotNull()),
    ]
    return rows.select(
        F.concat(F.lit(f"{id_prefix}-{month}-row-"), F.col("source_row").cast("string")).alias("event_id"),
        "source_row",
        at.alias("event_time"),
        "event_type",
        "product_id",
        "user_id",
        empty_to_null(F.col("user_session")).alias("session_id"),
        _category().alias("category"),
        empty_to_null(F.col("brand")).alias("brand"),
        price.alias("price_minor"),
        at.cast("date").cast("string").alias("event_date"),
        _first_reason(rules).alias("reject_reason"),
        _record().alias("record"),
    )


def accepted_history(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("reject_reason").isNull()).select(*HISTORY_FIELDS)


def rejects(routed: DataFrame) -> DataFrame:
    """Refused rows: row number, reason and the record as it was read."""
    return routed.filter(F.col("reject_reason").isNotNull()).select(
        "source_row", F.col("reject_reason").alias("reason"), "record"
    )


def normalize_history(rows: DataFrame, month: str, id_prefix: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects) of one month."""
    routed = route_history(rows, month, id_prefix)
    return accepted_history(routed), rejects(routed)


def route_replay(rows: DataFrame, namespace: str, id_prefix: str) -> DataFrame:
    """Live-contract events for every source row, with ``reject_reason`` and ``record``.

    Ids get the namespace of the source, so that they never mix with other events. The source has
    no quantity and no currency: quantity is 1 and marked as not observed, prices are in source
    units. A missing session becomes a placeholder of its own, marked as not observed.
    """
    rows = compute_once(_measured(rows), _iso=iso_utc(F.col("_at")))
    at, price, iso = F.col("_at"), F.col("_minor"), F.col("_iso")
    row = F.col("source_row").cast("string")
    session = strip(F.coalesce("user_session", F.lit("")))
    observed = session != ""
    missing = F.concat(F.lit(C.MISSING_SESSION_PREFIX), row)
    rules = [
        (C.REASON_TYPE, F.col("event_type").isin(*C.HISTORY_EVENT_TYPES)),
        (C.REASON_TIME, at.isNotNull()),
        (C.REASON_PRICE, is_number(F.col("price"))),
        (C.REASON_PRICE_RANGE, price.isNotNull()),
        *[(C.REASON_MISSING + name, not_blank(F.col(name))) for name in ("user_id", "product_id", "category_id")],
    ]
    fields = {
        "schema_version": F.lit(C.SCHEMA_VERSION),
        "event_id": F.concat(F.lit(f"{id_prefix}-row-"), row),
        "event_time": iso,
        "user_id": F.concat(F.lit(namespace), "user_id"),
        "session_id": F.concat(F.lit(namespace), F.when(observed, session).otherwise(missing)),
        "event_type": F.col("event_type"),
        "product_id": F.concat(F.lit(namespace), "product_id"),
        "product_name": F.col("product_id"),
        "category": _category(),
        "quantity": F.lit(1).cast("bigint"),
        "price_paise": price,
        "data_source": F.lit(C.REAL_SOURCE),
        "source_event_time": iso,
        "currency": F.lit(C.SOURCE_CURRENCY),
        "session_observed": observed,
        "quantity_observed": F.lit(False),
        "source_row": F.col("source_row"),
    }
    return rows.select(
        *[column.alias(name) for name, column in fields.items()],
        _first_reason(rules).alias("reject_reason"),
        _record().alias("record"),
    )


def normalize_replay(rows: DataFrame, namespace: str, id_prefix: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects) of one replay source."""
    routed = route_replay(rows, namespace, id_prefix)
    accepted = routed.filter(F.col("reject_reason").isNull()).select(*REPLAY_FIELDS)
    return accepted, rejects(routed)


def source_prefix(rows: DataFrame, count: int) -> DataFrame:
    """The first ``count`` source rows: a chronological prefix, not a random sample."""
    if count < 1:
        raise ValueError("a prefix has at least one row")
    return rows.filter(F.col("source_row") <= count)


def replay_slice(
    positioned: DataFrame, position: int, count: int, run_id: int = 0, at: datetime | str | None = None
) -> DataFrame:
    """The next ``count`` events after ``position``, stamped with the delivery time ``at``.

    ``positioned`` has a dense ``position``; the slice is a range filter that reaches the scan. The
    source time is kept. Repeated runs get new event and session ids, the same ones on every retry.
    The next cursor is the largest position of the slice, or ``position`` when it is empty.
    """
    if at is None:
        raise ValueError("the delivery time must be given, so that a retry repeats it")
    stamp = at if isinstance(at, str) else at.isoformat()
    rows = positioned.filter((F.col("position") > position) & (F.col("position") <= position + count))
    rows = rows.withColumn("event_time", F.lit(stamp))
    if run_id:
        for name in ("event_id", "session_id"):
            rows = rows.withColumn(name, F.concat(F.lit(f"{C.REPLAY_RUN_PREFIX}{run_id}:"), name))
    return rows


def next_cursor(piece: DataFrame, position: int) -> int:
    return piece.agg(F.coalesce(F.max("position"), F.lit(position)).alias("cursor")).first()["cursor"]


def import_manifest(routed: DataFrame) -> DataFrame:
    """Source, accepted and rejected rows, accepted rows by type, first and last accepted time."""
    kept = F.col("reject_reason").isNull()
    kinds = [
        F.count_if(kept & (F.col("event_type") == kind)).alias(f"{kind}_rows") for kind in C.HISTORY_EVENT_TYPES
    ]
    return routed.agg(
        F.count(F.lit(1)).alias("source_rows"),
        F.count_if(kept).alias("accepted_rows"),
        F.count_if(~kept).alias("rejected_rows"),
        *kinds,
        F.min(F.when(kept, F.col("event_time"))).alias("first_event_time"),
        F.max(F.when(kept, F.col("event_time"))).alias("last_event_time"),
    )
