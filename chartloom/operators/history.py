"""Questions over all collected days."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartloom.functions import count_when, percent, rate
from chartloom.operators.joins import join_previous_day
from chartloom.operators.scope import Scope, scope_filter
from chartloom.schemas import CHART, ChartColumns


def daily_totals(df: DataFrame, scope: Scope = Scope(), cols: ChartColumns = CHART) -> DataFrame:
    """Per date: rows, distinct videos, total views."""
    return (
        scope_filter(df, scope.all_days(), cols)
        .groupBy(cols.date)
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_distinct(cols.entity).alias("unique_videos"),
            F.sum(cols.views).alias("total_views"),
        )
        .orderBy(cols.date)
    )


def staying_power(df: DataFrame, scope: Scope = Scope(), cols: ChartColumns = CHART) -> DataFrame:
    """How many videos charted on 1, 2, 3 ... different days."""
    return (
        scope_filter(df, scope.all_days(), cols)
        .groupBy(cols.entity)
        .agg(F.count_distinct(cols.date).alias("days"))
        .groupBy("days")
        .agg(F.count(F.lit(1)).alias("videos"))
        .orderBy("days")
    )


def one_day_share(staying: DataFrame) -> DataFrame:
    """Percentage of videos seen on one day only; no row if there are none."""
    return (
        staying.agg(
            F.sum(F.when(F.col("days") == 1, F.col("videos"))).alias("_once"),
            F.sum("videos").alias("_all"),
        )
        .filter("_once IS NOT NULL")
        .select(rate(F.col("_once"), F.col("_all")).alias("one_day_pct"))
    )


def daily_churn(df: DataFrame, scope: Scope = Scope(), cols: ChartColumns = CHART) -> DataFrame:
    """Per date the videos that were not charting the calendar day before.

    The first collected date, having nothing to compare with, is left out.  A
    day after a gap is all new.
    """
    rows = scope_filter(df, scope.all_days(), cols).select(cols.date, cols.entity)
    compared = (
        join_previous_day(rows, cols.entity, cols.date)
        .groupBy(cols.date)
        .agg(
            F.count(F.lit(1)).alias("videos"),
            count_when(~F.col("seen_before")).alias("new_videos"),
        )
    )
    # one row per day
    first = F.min(cols.date).over(Window.partitionBy())
    return (
        compared.withColumn("_first", first)
        .filter(F.col(cols.date) > F.col("_first"))
        .select(
            cols.date,
            "videos",
            "new_videos",
            percent(F.col("new_videos"), F.col("videos"), 1).alias("new_pct"),
        )
        .orderBy(cols.date)
    )


def avg_turnover(churn: DataFrame) -> DataFrame:
    """Mean share of new videos over the days of a churn table."""
    return churn.agg(F.avg("new_pct").alias("avg_new_pct"))
