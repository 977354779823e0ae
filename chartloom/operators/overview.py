"""Headline figures and their change from one collected day to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartloom.functions import lower_median, none_if_zero, with_median
from chartloom.operators.joins import region_lists
from chartloom.operators.scope import Scope, scope_filter
from chartloom.schemas import CHART, ChartColumns

_FIGURES = ["row_count", "unique_videos", "channels", "total_views", "median_views"]


def _figures(rows: DataFrame, by: list[str], cols: ChartColumns) -> DataFrame:
    # one row per entity and channel first: both distinct counts and the sums
    # come from it without doubling the rows
    pairs = rows.groupBy(*by, cols.entity, cols.channel_id).agg(
        F.count(F.lit(1)).alias("n"), F.sum(cols.views).alias("views")
    )
    figures = pairs.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.count_distinct(cols.entity).alias("unique_videos"),
        F.count_distinct(cols.channel_id).alias("channels"),
        F.sum("views").alias("total_views"),
    )
    medians = lower_median(rows, by, cols.views, "median_views")
    return with_median(figures, medians, by, "median_views").select(*by, *_FIGURES)


def overview(df: DataFrame, scope: Scope = Scope(), cols: ChartColumns = CHART) -> DataFrame:
    """Rows, distinct videos and channels, total and median views, as one row.

    Totals count a video once per region it charts in; see ``dedup_region_sum``.
    """
    return _figures(scope_filter(df, scope, cols), [], cols)


def previous_date(df: DataFrame, date: str, cols: ChartColumns = CHART):
    """The collected date before ``date``, or None (reads one aggregate row)."""
    earlier = df.filter(F.col(cols.date) < F.lit(str(date)).cast("date"))
    return earlier.agg(F.max(cols.date)).first()[0]


def overview_delta(
    df: DataFrame, scope: Scope = Scope(), cols: ChartColumns = CHART
) -> DataFrame:
    """Per date the headline figures and their change.

    The change is against the previous *collected* day, however long ago, and
    NULL where there is none or it is zero.  With a date in the scope only that
    day and its predecessor are read.
    """
    collected = df
    if scope.date is not None:
        # the predecessor is looked up over all regions, as dates are collected whole
        wanted = [d for d in (previous_date(df, str(scope.date), cols), scope.date) if d]
        collected = df.filter(F.col(cols.date).isin(*[F.lit(str(d)).cast("date") for d in wanted]))
    daily = _figures(scope_filter(collected, scope.all_days(), cols), [cols.date], cols)
    # a day on which the chosen regions have no rows counts with zeros
    days = collected.select(F.col(cols.date).alias("_day")).distinct()
    daily = days.join(daily, F.col("_day") == F.col(cols.date), "left").select(
        F.col("_day").alias(cols.date),
        *[F.coalesce(f, F.lit(0)).alias(f) for f in _FIGURES if f != "median_views"],
        "median_views",
    )
    # one row per collected day
    in_order = Window.orderBy(cols.date)
    out = daily.select(
        cols.date,
        *_FIGURES,
        *[
            none_if_zero(F.col(f) - F.lag(f).over(in_order)).alias(f"{f}_delta")
            for f in _FIGURES
        ],
    )
    if scope.date is not None:
        out = out.filter(F.col(cols.date) == F.lit(str(scope.date)).cast("date"))
    return out


def spread(df: DataFrame, scope: Scope, cols: ChartColumns = CHART) -> DataFrame:
    """Videos, videos in more than one region, and their percentage (0 if none)."""
    regions = scope.region_list()
    per_video = region_lists(scope_filter(df, scope, cols), [cols.entity], regions, cols=cols)
    totals = per_video.agg(
        F.count(F.lit(1)).alias("videos"),
        F.coalesce(F.sum(F.when(F.size("pattern") > 1, 1).otherwise(0)), F.lit(0)).alias(
            "shared_videos"
        ),
    )
    return totals.withColumn(
        "shared_pct",
        F.when(F.col("videos") > 0, F.lit(100.0) * F.col("shared_videos") / F.col("videos"))
        .otherwise(F.lit(0.0)),
    )


def chart_size(df: DataFrame, scope: Scope = Scope(), cols: ChartColumns = CHART) -> DataFrame:
    """Per region: rows, total views, median views."""
    rows = scope_filter(df, scope, cols)
    figures = rows.groupBy(cols.region).agg(
        F.count(F.lit(1)).alias("videos"), F.sum(cols.views).alias("total_views")
    )
    medians = lower_median(rows, [cols.region], cols.views, "median_views")
    return with_median(figures, medians, [cols.region], "median_views")
