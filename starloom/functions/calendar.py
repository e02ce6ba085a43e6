"""Epoch conversion and calendar parts, all on naive UTC timestamps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _epoch() -> Column:
    return F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00"))


def from_epoch_millis(ts: Column) -> Column:
    """Epoch milliseconds (number or digits) to a timestamp, milliseconds kept.

    Plain interval arithmetic, so the session time zone has no say in the result.
    """
    return _epoch() + ts.cast("bigint") * F.expr("INTERVAL '0.001' SECOND")


def from_epoch_seconds(ts: Column) -> Column:
    """Epoch milliseconds to a timestamp cut to whole seconds."""
    seconds = F.call_function("div", ts.cast("bigint"), F.lit(1000).cast("bigint"))
    return _epoch() + seconds * F.expr("INTERVAL '1' SECOND")


PRECISIONS = {"ms": from_epoch_millis, "s": from_epoch_seconds}

# Day-of-week numberings; "week" repeats the ISO week, as one of the loaders does.
WEEKDAYS = {
    "mon0": F.weekday,
    "sun1": F.dayofweek,
    "sun0": lambda ts: F.dayofweek(ts) - F.lit(1),
    "week": F.weekofyear,
}


def calendar_parts(ts: Column, weekday: str = "mon0") -> list[Column]:
    """hour, day, ISO week, month, year and weekday of a timestamp."""
    return [
        F.hour(ts).alias("hour"),
        F.dayofmonth(ts).alias("day"),
        F.weekofyear(ts).alias("week"),
        F.month(ts).alias("month"),
        F.year(ts).alias("year"),
        WEEKDAYS[weekday](ts).alias("weekday"),
    ]


def from_sas_date(days: Column) -> Column:
    """SAS day number (days since 1960-01-01) to a date."""
    return F.date_add(F.to_date(F.lit("1960-01-01")), days.cast("int"))
