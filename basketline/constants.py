"""Values of the event contract, the history layout and the report definitions."""

# --- Fixed values of the versioned event contract -------------------------------------
SCHEMA_VERSION = 1
EVENT_TYPES = ("view", "search", "cart", "purchase", "remove_from_cart")
REQUIRED_IDS = ("event_id", "user_id", "session_id", "product_id", "category")
MAX_ID_LENGTH = 128
QUANTITY_RANGE = (1, 1000)
PRICE_RANGE = (0, 100_000_000)
ZONE_SUFFIX = r"(Z|[+-]\d{2}:\d{2})$"
FUTURE_ALLOWANCE = "5 minutes"

# Fixed reject reasons of the live contract, in the order the rules are applied.
REASON_NOT_JSON = "malformed JSON"
REASON_NOT_OBJECT = "event must be a JSON object"
REASON_VERSION = "unsupported schema_version"
REASON_INVALID = "invalid "  # followed by the field name
REASON_TIME = "invalid event_time"
REASON_ZONE = "timestamp must include timezone"
REASON_FUTURE = "event timestamp too far in the future"

# --- Fixed values of the monthly history files ----------------------------------------
HISTORY_CSV_FIELDS = (
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "category_code",
    "brand",
    "price",
    "user_id",
    "user_session",
)
HISTORY_EVENT_TYPES = ("view", "cart", "purchase", "remove_from_cart")
HISTORY_TIME_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2} UTC$"
MONTH_FORMAT = "%Y-%b"

# Fixed texts of normalised rows.
CATEGORY_PREFIX = "category:"
UNKNOWN_CATEGORY = "unknown"
MISSING_SESSION_PREFIX = "missing-row-"
REPLAY_RUN_PREFIX = "replay-"
REAL_SOURCE = "real"
SYNTHETIC_SOURCE = "synthetic"
SOURCE_CURRENCY = "SOURCE_UNITS"

# Fixed texts of a month's manifest.
MONTH_COMPLETE = "complete"
COVERAGE_OFFICIAL = "whole month, as published"
COVERAGE_SUPPLIED = "a given file; that it covers the whole month is unverified"
HISTORY_SCOPE = "Times and prices as in the source; a purchase record counts as one unit."

# Fixed reject reasons of the history and replay normalisers.
REASON_MONTH = "timestamp outside requested month"
REASON_TYPE = "unsupported event type"
REASON_MISSING = "missing "  # followed by the field name
REASON_PRICE = "invalid price"
REASON_PRICE_RANGE = "invalid price precision or range"

# --- Fixed names of queries and stages ------------------------------------------------
BRONZE = "bronze-v1"
QUARANTINE = "quarantine-v1"
SILVER = "silver-v1"
SALES = "sales-1m-v1"
TRENDING = "trending-5m-v1"

STAGE_LABELS = {
    "bronze-v1": "raw records",
    "silver-v1": "valid events, once each",
    "quarantine-v1": "refused records",
    "sales-1m-v1": "totals by minute",
    "trending-5m-v1": "activity over five minutes",
}

# (query name, window size, slide)
METRIC_WINDOWS = (
    (SALES, "1 minute", "1 minute"),
    (TRENDING, "5 minutes", "1 minute"),
)

# Columns that must agree exactly between a stream and a recomputation.
METRIC_KEYS = ("window_start", "window_end", "category", "product_id")
EXACT_MEASURES = ("events", "purchases", "revenue_paise", "views", "carts")
APPROX_MEASURE = "active_users_approx"

# --- Fixed parameters of the estimates ------------------------------------------------
DISTINCT_RSD = 0.05
SAMPLE_FRACTIONS = (0.01, 0.05, 0.1, 0.5, 1.0)
SAMPLE_SEED = 404
