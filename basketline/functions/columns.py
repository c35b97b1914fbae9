"""Column expressions: text, time, money and conditional totals. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketline import constants as C


def compute_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are evaluated exactly once per row, however often they are used later.

    Projections are merged and filters are moved below them, both by repeating the expression. A
    generator that makes one row of each row is left where it is.
    """
    fields = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(fields)))


def not_blank(text: Column) -> Column:
    """True when any non-whitespace character is present (``trim`` would only see spaces)."""
    return text.rlike(r"\S")


def empty_to_null(text: Column) -> Column:
    return F.when(text != "", text)


def strip(text: Column) -> Column:
    """Remove every kind of surrounding whitespace."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def has_zone(text: Column) -> Column:
    return text.rlike(C.ZONE_SUFFIX)


def zoned_timestamp(text: Column) -> Column:
    """Instant of an ISO text that carries a date and an explicit offset; NULL for anything else."""
    return F.when(has_zone(text) & text.rlike(r"^\s*[+-]?\d{4,}-\d"), F.try_to_timestamp(text))


def history_timestamp(text: Column) -> Column:
    """Instant of the history format; NULL when the text has any other shape."""
    utc = F.concat(F.substring(text, F.lit(1), F.length(text) - 4), F.lit("Z"))
    return F.when(text.rlike(C.HISTORY_TIME_SHAPE), F.try_to_timestamp(utc))


def iso_utc(ts: Column) -> Column:
    """ISO text with the UTC offset, seconds precision as in the history source."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def exact_minor_units(price: Column) -> Column:
    """Integer minor units of a decimal text, or NULL when it is not an exact amount in range.

    Plain amounts such as ``12.34`` take a short way. For the rest, NaN and infinities do not cast,
    and since a decimal(38,18) cast rounds beyond 18 places, texts with significant digits further
    right are refused instead of being rounded to a whole cent.
    """
    low, high = C.PRICE_RANGE
    plain = (price.cast("decimal(11,2)") * 100).cast("bigint")
    text = strip(price)
    fraction = F.length(F.regexp_extract(text, r"\.(\d*?)0*(?:[eE]|$)", 1))
    exponent = F.coalesce(
        F.regexp_extract(text, r"[eE]([+-]?\d{1,6})$", 1).try_cast("int"), F.lit(0)
    )
    cents = text.try_cast("decimal(38,18)") * 100
    exact = (fraction - exponent <= 18) & (cents == F.floor(cents)) & cents.between(low, high)
    return F.when(price.rlike(r"^\d{1,6}(\.\d{1,2})?$"), plain).otherwise(
        F.when(exact, cents.cast("bigint"))
    )


def is_number(text: Column) -> Column:
    """True for any numeric text, the special values included."""
    return strip(text).try_cast("double").isNotNull()


def of_type(kind: str) -> Column:
    return F.col("event_type") == kind


def purchase_value(quantity: str = "quantity", price: str = "price_paise") -> Column:
    """Quantity times price on purchases, zero on every other action."""
    return F.when(of_type("purchase"), F.col(quantity) * F.col(price)).otherwise(F.lit(0).cast("bigint"))


def total(column: Column | str) -> Column:
    """A sum that is zero, not NULL, on empty input."""
    return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double ratio; NULL on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def percent(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(F.lit(100.0) * numerator.cast("double"), denominator.cast("double"))


def product_label(product_id: Column, namespace: str, names: dict[str, str] | None = None) -> Column:
    """Catalogue name, or ``Product <id>`` without the namespace. The catalogue is a small literal map."""
    bare = F.when(
        product_id.startswith(namespace), F.substr(product_id, F.lit(len(namespace) + 1))
    ).otherwise(product_id)
    fallback = F.concat(F.lit("Product "), bare)
    if not names:
        return fallback
    lookup = F.create_map(*[F.lit(part) for pair in names.items() for part in pair])
    return F.coalesce(F.try_element_at(lookup, product_id), fallback)


def category_label(category: Column) -> Column:
    """``a.b_c`` becomes ``A › b c``: first letter upper case, the rest lower case."""
    text = F.replace(F.replace(category, F.lit("."), F.lit(" › ")), F.lit("_"), F.lit(" "))
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substr(text, F.lit(2))))


def money_label(minor: Column, symbol: str = "") -> Column:
    """``1,234.50`` from minor units, after a currency symbol if the currency is known; NULL counts as 0."""
    amount = F.coalesce(minor, F.lit(0)).cast("decimal(38,0)") / F.lit(100).cast("decimal(3,0)")
    return F.concat(F.lit(symbol), F.format_number(amount.cast("decimal(38,2)"), 2))
