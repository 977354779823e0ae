"""Ranking, limits and shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.operators.positions import list_positions


def top_k(df: DataFrame, order: list[Column], k: int, tie: list[str]) -> DataFrame:
    """The first k rows; ``tie`` names the key that settles equal rows."""
    return df.orderBy(*order, *[F.asc(c) for c in tie]).limit(k)


def top_k_per_group(
    df: DataFrame, group: list[str], order: list[Column], k: int
) -> DataFrame:
    """The first k rows of every group.

    Spark keeps only k rows per group and task before the exchange
    (WindowGroupLimit), so a hot group does not travel whole.
    """
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= k).drop("_place")


def rank_groups(
    grouped: DataFrame, by: Column, tie: list[str], k: int | None = None, out: str = "rn"
) -> DataFrame:
    """Number grouped rows over the whole result, best first.

    With ``k`` only the first k are kept and numbered.  Without it every group
    is numbered, spread over ranges instead of one global window.
    """
    order = [by, *[F.asc(c) for c in tie]]
    if k is None:
        return list_positions(grouped, [], order, out)
    # k rows by construction, so the global window is small
    first = grouped.orderBy(*order).limit(k)
    return first.withColumn(out, F.row_number().over(Window.orderBy(*order)).cast("bigint"))


def share_of(grouped: DataFrame, n: str, part: list[str], digits: int = 1) -> DataFrame:
    """Add ``pct``: n in percent of the total of its partition.

    ``grouped`` is already aggregated, one row per group of a report.
    """
    total = F.sum(n).over(Window.partitionBy(*part))
    return grouped.withColumn("pct", F.round(F.lit(100.0) * F.col(n) / total, digits))
