"""Time expressions.  All of them assume a UTC session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def iso_instant(text: Column | str) -> Column:
    """ISO-8601 text with zone to a timestamp; malformed text raises."""
    return F.to_timestamp(text)


def iso_text(instant: Column | str) -> Column:
    return F.date_format(instant, ISO_PATTERN)


def whole_hours(start: Column, end: Column) -> Column:
    """Complete hours from start to end, truncated towards zero."""
    return F.timestamp_diff("HOUR", start, end)


def local_hour(instant: Column, offset_hours: int) -> Column:
    """Hour of day under a fixed offset from UTC (no named zone, no DST)."""
    return F.hour(F.timestamp_add("HOUR", F.lit(offset_hours), instant))
