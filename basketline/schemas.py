"""Explicit schemas, so that no source is ever read twice to infer one."""

from pyspark.sql import types as T

from basketline.constants import HISTORY_CSV_FIELDS

KINDS = {
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
}


def row(text: str) -> T.StructType:
    """Schema of ``name type, name type, …``; unlike a DDL text it needs no running session."""
    pairs = [part.split() for part in text.replace("\n", " ").split(",") if part.strip()]
    return T.StructType([T.StructField(name, KINDS[kind]) for name, kind in pairs])


# One live event as JSON; the last six fields are optional replay provenance.
EVENT = row(
    """
    schema_version int,
    event_id string,
    event_time string,
    user_id string,
    session_id string,
    event_type string,
    product_id string,
    product_name string,
    category string,
    quantity bigint,
    price_paise bigint,
    data_source string,
    source_event_time string,
    currency string,
    session_observed boolean,
    quantity_observed boolean,
    source_row bigint
    """
)

# A raw record with the coordinates of the log it came from.
RAW = row(
    "raw_json string, topic string, partition int, offset bigint, ingested_at timestamp"
)

# A valid event: contract fields, event clock, coordinates.
SILVER = T.StructType(
    [f for f in RAW.fields if f.name != "raw_json"]
    + EVENT.fields
    + [T.StructField("event_ts", T.TimestampType())]
)

# A normalised history row; event_date is the partition column.
HISTORY = row(
    """
    event_id string,
    source_row bigint,
    event_time timestamp,
    event_type string,
    product_id string,
    user_id string,
    session_id string,
    category string,
    brand string,
    price_minor bigint,
    event_date string
    """
)

HISTORY_CSV = T.StructType([T.StructField(name, T.StringType()) for name in HISTORY_CSV_FIELDS])

WINDOW_METRICS = row(
    """
    window_start timestamp,
    window_end timestamp,
    category string,
    product_id string,
    events bigint,
    purchases bigint,
    revenue_paise bigint,
    views bigint,
    carts bigint,
    active_users_approx bigint
    """
)

# One row per reported micro-batch of one query.
PROGRESS = row(
    "query_name string, batch_id bigint, progress string, updated_at timestamp"
)
