"""Arithmetic shared by the analytic operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A median is found by this many bits of its value at a time, the high ones first.
MEDIAN_SHIFTS = (40, 20, 0)


def rate(part: Column, whole: Column) -> Column:
    """100 * part / whole as DOUBLE; NULL where whole is zero or NULL."""
    return F.lit(100.0) * part / F.nullif(whole, F.lit(0))


def percent(part: Column, whole: Column, digits: int) -> Column:
    return F.round(rate(part, whole), digits)


def lower_median(rows: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """Per group the exact lower median of an integral column: an element, never interpolated.

    The rows are read once and counted per distinct value.  Each pass then sums
    these counts by the leading bits of the values that are left, walks the sums
    of a group in order to the one that holds the middle row, and leaves the
    values with these bits.  A group has at most 2 ** 24 different bits in the
    first pass and 2 ** 20 in the others, whatever its size, so no task holds
    more of it.  NULLs do not count; a group without a value has no row.
    """
    kind = rows.schema[value].dataType
    if not isinstance(kind, T.IntegralType):
        raise TypeError(f"the median of {value} needs integers, not {kind.simpleString()}")
    present = rows.select(*by, F.col(value).cast("bigint").alias("_value")).filter("_value is not null")
    counts = present.groupBy(*by, "_value").agg(F.count("*").alias("_times"))
    group = Window.partitionBy(*by)
    found = None
    for shift in MEDIAN_SHIFTS:
        bits = F.shiftright("_value", shift).alias("_bits")
        if found is None:
            sums = counts.groupBy(*by, bits).agg(F.sum("_times").alias("_times"))
            # the middle row, counted from 1
            sums = sums.withColumn("_rank", F.expr("(sum(_times) OVER (PARTITION BY %s) + 1) div 2" % _names(by)))
        else:
            held = found.select(*(F.col(c).alias(f"_by_{c}") for c in by), F.col("_bits").alias("_held"), "_rank")
            same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
            match = reduce(lambda a, b: a & b, same, F.shiftright("_value", before).eqNullSafe(F.col("_held")))
            left = counts.join(held, match)
            sums = left.groupBy(*by, bits).agg(F.sum("_times").alias("_times"), F.first("_rank").alias("_rank"))
        upto = F.sum("_times").over(group.orderBy("_bits").rowsBetween(Window.unboundedPreceding, 0))
        walked = sums.withColumn("_upto", upto)
        middle = walked.filter("_upto >= _rank AND _upto - _times < _rank")
        found = middle.select(*by, "_bits", (F.col("_rank") - F.col("_upto") + F.col("_times")).alias("_rank"))
        before = shift
    return found.select(*by, F.col("_bits").cast(kind).alias(name))


def _names(by: list[str]) -> str:
    return ", ".join(f"`{c}`" for c in by) or "1"


def with_median(figures: DataFrame, medians: DataFrame, by: list[str], name: str) -> DataFrame:
    """Add the median of :func:`lower_median` to one row per group."""
    if not by:
        both = figures.unionByName(medians, allowMissingColumns=True)
        return both.agg(*[F.max(c).alias(c) for c in (*figures.columns, name)])
    other = medians.select(*(F.col(c).alias(f"_by_{c}") for c in by), name)
    match = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by))
    return figures.join(other, match, "left").select(*figures.columns, name)


def none_if_zero(value: Column) -> Column:
    return F.nullif(value, F.lit(0))


def to_count(value: Column, strict: bool = True) -> Column:
    """Text counter to bigint; NULL stays NULL, malformed raises if strict."""
    return value.cast("bigint") if strict else value.try_cast("bigint")


def count_when(condition: Column) -> Column:
    return F.sum(F.when(condition, 1).otherwise(0))


def changed(before: list[Column], after: list[Column]) -> Column:
    """True where any pair differs, NULL being a value like any other."""
    return reduce(lambda a, b: a | b, (~x.eqNullSafe(y) for x, y in zip(before, after)))
