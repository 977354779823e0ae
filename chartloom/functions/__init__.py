from chartloom.functions.measures import (
    changed,
    count_when,
    lower_median,
    none_if_zero,
    percent,
    rate,
    to_count,
    with_median,
)
from chartloom.functions.time import iso_instant, iso_text, local_hour, whole_hours

__all__ = [
    "changed",
    "count_when",
    "iso_instant",
    "iso_text",
    "local_hour",
    "lower_median",
    "none_if_zero",
    "percent",
    "rate",
    "to_count",
    "whole_hours",
    "with_median",
]
