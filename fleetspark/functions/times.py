"""Time helpers shared by operators and reports."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def moment(value: datetime | str | Column) -> Column:
    """A timestamp literal; naive datetimes and texts are read as UTC."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    if value.tzinfo is None:
        value = value.replace(tzinfo=timezone.utc)
    seconds = int(value.replace(microsecond=0).timestamp())
    return F.timestamp_micros(F.lit(seconds * 1_000_000 + value.microsecond))


def seconds_between(earlier: Column, later: Column) -> Column:
    """later - earlier in seconds, with microseconds kept."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1_000_000.0)


def minus_seconds(value: Column, seconds: float) -> Column:
    return F.timestamp_micros(F.unix_micros(value) - F.lit(round(seconds * 1_000_000)))


def utc_text(value: Column) -> Column:
    """Readable UTC text with milliseconds and a zone mark."""
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSS'Z'")


def month_of(value: Column) -> Column:
    """Partition value of the history tables: yyyymm as an integer."""
    return F.year(value) * 100 + F.month(value)
