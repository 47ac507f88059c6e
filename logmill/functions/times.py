"""Event-time resolution: epoch numbers of several units and ISO-8601 instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An epoch number above the first bound counts nanoseconds, above
# the second milliseconds, otherwise seconds.
NANOS_ABOVE = 9_999_999_999_999_999
MILLIS_ABOVE = 9_999_999_999
# 9999-12-31T23:59:59.999Z, the last instant kept as a timestamp
LAST_MILLI = 253_402_300_799_999
FIRST_SECOND = -62_135_596_800

_ISO = (
    r"^\d{4}-\d\d-\d\d[Tt]\d\d:\d\d:\d\d(\.\d{0,9})?([Zz]|[+-]\d\d:\d\d(:\d\d)?)$"
)
_NUMBER = r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
_NUMBER_SCHEMA = r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)"


def epoch_number(value: Column) -> Column:
    """BIGINT epoch of unknown unit to TIMESTAMP; NULL beyond the year range."""
    in_range = (value <= LAST_MILLI) & (value >= F.lit(FIRST_SECOND))
    return (
        F.when(value > NANOS_ABOVE, F.timestamp_micros(F.call_function("div", value, F.lit(1000))))
        .when((value > MILLIS_ABOVE) & in_range, F.timestamp_millis(value))
        .when((value <= MILLIS_ABOVE) & in_range, F.timestamp_seconds(value))
    )


def resolve_event_time(raw: Column, text: Column) -> tuple[Column, Column]:
    """``(timestamp, failure)`` for a raw JSON value and its text.

    Both are NULL when there is no time at all; the caller then falls back to
    the arrival time.
    """
    blank = text.isNull() | ~text.rlike(r"[^\s\p{Z}]")
    digits = text.rlike(r"^[0-9]+$")
    # whether a number was a JSON number matters only if it is not all digits
    numeric = F.when(
        text.rlike(_NUMBER) & ~digits,
        F.coalesce(F.schema_of_variant(raw).rlike(_NUMBER_SCHEMA), F.lit(False)),
    ).otherwise(F.lit(False))
    number = F.when(digits, text.try_cast("bigint")).when(
        numeric, F.coalesce(text.try_cast("bigint"), text.try_cast("double").try_cast("bigint"))
    )
    iso = F.when(text.rlike(_ISO), F.upper(text).try_cast("timestamp"))
    resolved = F.when(blank, None).when(digits | numeric, epoch_number(number)).otherwise(iso)
    failure = (
        F.when(blank | resolved.isNotNull(), None)
        .when((digits | numeric) & number.isNotNull(), F.lit("event_time_out_of_range"))
        .otherwise(F.lit("event_time_unparseable"))
    )
    return resolved, failure
