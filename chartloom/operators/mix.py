"""Categories and publishing hours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions import (
    count_when,
    iso_instant,
    local_hour,
    lower_median,
    percent,
    whole_hours,
    with_median,
)
from chartloom.operators.scope import Scope, scope_filter
from chartloom.operators.topk import share_of, top_k
from chartloom.schemas import CHART, ChartColumns


def _largest(counted: DataFrame, group: str, k: int) -> DataFrame:
    """The k groups with most rows, out of counts that may be split further."""
    totals = counted.groupBy(group).agg(F.sum("videos").alias("_total"))
    return top_k(totals, [F.desc("_total")], k, [group]).select(group)


def category_mix(
    df: DataFrame, scope: Scope = Scope(), top: int = 5, cols: ChartColumns = CHART
) -> DataFrame:
    """Per region the largest categories of the whole scope, the rest as ``Other``.

    The rows are read once, for counts by (region, category); totals, labels
    and shares come from those counts.  Rows without a category drop out.
    """
    counted = (
        scope_filter(df, scope, cols)
        .filter(F.col(cols.category).isNotNull())
        .groupBy(cols.region, cols.category)
        .agg(F.count(F.lit(1)).alias("videos"))
    )
    largest = _largest(counted, cols.category, top).withColumn("_large", F.lit(True))
    labelled = counted.join(F.broadcast(largest), cols.category, "left").select(
        cols.region,
        F.when(F.col("_large"), F.col(cols.category)).otherwise("Other").alias("category"),
        "videos",
    )
    mix = labelled.groupBy(cols.region, "category").agg(F.sum("videos").alias("videos"))
    return share_of(mix, "videos", [cols.region])


def category_order(mix: DataFrame) -> DataFrame:
    """Legend order of a category mix: by size, ``Other`` last."""
    totals = mix.groupBy("category").agg(F.sum("videos").alias("videos"))
    return totals.orderBy(F.col("category") == "Other", F.desc("videos"), "category")


def hours_to_trend(
    df: DataFrame,
    scope: Scope = Scope(),
    min_rows: int = 5,
    digits: int = 1,
    cols: ChartColumns = CHART,
) -> DataFrame:
    """Per category the mean and median hours from publishing to charting.

    Categories with fewer than ``min_rows`` rows are left out.
    """
    hours = whole_hours(iso_instant(cols.published_at), iso_instant(cols.pulled_at))
    rows = scope_filter(df, scope, cols).select(cols.category, hours.alias("hours"))
    figures = (
        rows.groupBy(cols.category)
        .agg(
            F.count(F.lit(1)).alias("videos"),
            F.round(F.avg("hours"), digits).alias("avg_hours"),
        )
        .filter(F.col("videos") >= min_rows)
    )
    medians = lower_median(rows, [cols.category], "hours", "median_hours")
    rounded = F.round(F.col("median_hours").cast("double"), digits)
    return (
        with_median(figures, medians, [cols.category], "median_hours")
        .withColumn("median_hours", rounded)
        .orderBy("avg_hours", cols.category)
    )


def publish_hour(
    df: DataFrame,
    scope: Scope = Scope(),
    top: int = 5,
    offset_h: int = 3,
    cols: ChartColumns = CHART,
) -> DataFrame:
    """Rows per publishing hour (fixed offset) of the largest categories."""
    counted = (
        scope_filter(df, scope, cols)
        .filter(F.col(cols.category).isNotNull())
        .groupBy(
            cols.category,
            local_hour(iso_instant(cols.published_at), offset_h).alias("publish_hour"),
        )
        .agg(F.count(F.lit(1)).alias("videos"))
    )
    largest = _largest(counted, cols.category, top)
    return counted.join(F.broadcast(largest), cols.category, "left_semi").select(
        cols.category, "publish_hour", "videos"
    )


def category_share(
    df: DataFrame, scope: Scope, category: str, cols: ChartColumns = CHART
) -> DataFrame:
    """Per region the rows and the percentage of one category, largest first."""
    return (
        scope_filter(df, scope, cols)
        .groupBy(cols.region)
        .agg(
            F.count(F.lit(1)).alias("rows_total"),
            percent(
                count_when(F.col(cols.category) == category), F.count(F.lit(1)), 1
            ).alias("category_pct"),
        )
        .orderBy(F.desc("category_pct"), cols.region)
    )
