"""Column expressions shared by the operators. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values.
HIGH_RISK = "HIGH_RISK"
NORMAL = "NORMAL"
ALERT_THRESHOLD = 60.0
MINUTE_MS = 60_000
HOUR_MS = 3_600_000
DAY_MS = 86_400_000
# Epoch milliseconds outside the range of a 64-bit nanosecond clock (years 1677 to 2262) are bad values.
MAX_EPOCH_MS = 9_223_372_036_854


def percent(part: Column, whole: Column) -> Column:
    """``part / whole * 100``; 0.0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part, whole) * 100, F.lit(0.0))


def round_half_even(value: Column, scale: int | None) -> Column:
    return value if scale is None else F.bround(value, scale)


def alert_status(rate: Column, threshold: float = ALERT_THRESHOLD) -> Column:
    """Strictly above the threshold is high risk. Pass the rate before any rounding."""
    return F.when(rate > F.lit(float(threshold)), F.lit(HIGH_RISK)).otherwise(F.lit(NORMAL))


def valid_epoch_ms(timestamp: Column) -> Column:
    """The epoch milliseconds, or null where they name no time."""
    return F.when(timestamp.between(-MAX_EPOCH_MS, MAX_EPOCH_MS), timestamp)


def event_time(timestamp: Column) -> Column:
    """Epoch milliseconds to TIMESTAMP, keeping the milliseconds; null for a bad value."""
    return F.timestamp_millis(valid_epoch_ms(timestamp))


def pane_floor(timestamp: Column, pane_ms: int) -> Column:
    """Index of the pane (time slot of ``pane_ms``) that holds the event. Free of the session time zone."""
    return F.floor(valid_epoch_ms(timestamp) / F.lit(pane_ms))


def pane_ceil(timestamp: Column, pane_ms: int) -> Column:
    """Index of the first pane that starts at or after the event."""
    return F.ceil(valid_epoch_ms(timestamp) / F.lit(pane_ms))


def hour_of(timestamp: Column) -> Column:
    """UTC hour of an epoch-millisecond column as TIMESTAMP, whatever the session time zone is."""
    return F.timestamp_millis(pane_floor(timestamp, HOUR_MS) * F.lit(HOUR_MS))


def date_of(timestamp: Column) -> Column:
    """UTC date of an epoch-millisecond column."""
    return F.date_from_unix_date(pane_floor(timestamp, DAY_MS).cast("int"))


def utc_text(moment: Column, pattern: str) -> Column:
    """A TIMESTAMP as text in UTC, whatever the session time zone is."""
    return F.date_format(F.to_utc_timestamp(moment, F.current_timezone()), pattern)


def to_long(value: Column, data_type: T.DataType) -> Column:
    """Read a number as LONG; text such as ``117.0`` counts as a number, anything unreadable becomes null."""
    if isinstance(data_type, T.LongType):
        return value
    if isinstance(data_type, T.StringType):
        whole = value.try_cast("bigint")
        return F.coalesce(whole, value.try_cast("decimal(38,6)").try_cast("bigint"))
    return value.try_cast("bigint")


def clean_nan(value: Column, data_type: T.DataType) -> Column:
    """NaN becomes null, so that JSON carries a null instead of a bare NaN."""
    if isinstance(data_type, T.FloatType | T.DoubleType):
        return F.nanvl(value, F.lit(None).cast(data_type))
    return value


def first_list_item(value: Column, data_type: T.DataType) -> Column:
    """First entry of a list given as array or as JSON text; an empty string when there is none."""
    items = value if isinstance(data_type, T.ArrayType) else F.from_json(value, "array<string>")
    return F.coalesce(F.get(items, F.lit(0)).cast("string"), F.lit(""))


def json_list(text: Column, fields: str) -> Column:
    """The JSON text as a list of objects with ``fields``: of one, if it is an object and nothing else.

    Inside brackets, text behind the object makes the whole unreadable or a list of several.
    """
    return F.from_json(F.concat(F.lit("["), text, F.lit("]")), f"array<struct<{fields}>>")


def is_one_object(text: Column) -> Column:
    """Whether a text is one JSON object."""
    one = F.size(json_list(text, "any string")) == 1
    return F.coalesce(one & text.rlike(r"^[ \t\r\n]*\{"), F.lit(False))
