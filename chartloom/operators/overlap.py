"""Entities that chart in more than one region."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.operators.joins import pair_counts, region_lists, region_patterns
from chartloom.operators.scope import Scope, scope_filter
from chartloom.operators.topk import top_k
from chartloom.schemas import CHART, ChartColumns


def region_overlap(df: DataFrame, scope: Scope, cols: ChartColumns = CHART) -> DataFrame:
    """Ordered region pairs of the scope with the videos charting in both."""
    return pair_counts(scope_filter(df, scope, cols), scope.region_list(), [], cols)


def avg_daily_overlap(df: DataFrame, scope: Scope, cols: ChartColumns = CHART) -> DataFrame:
    """Mean shared videos per region pair over the days on which it shared any."""
    daily = pair_counts(
        scope_filter(df, scope.all_days(), cols), scope.region_list(), [cols.date], cols
    )
    return daily.groupBy("region_a", "region_b").agg(
        F.round(F.sum("shared").cast("double") / F.count(F.lit(1)), 0).alias("avg_shared")
    )


def exclusive_shared(df: DataFrame, scope: Scope, cols: ChartColumns = CHART) -> DataFrame:
    """Per region the rows whose video charts there only, and in several regions.

    A video counts as shared over the whole scope.
    """
    regions = scope.region_list()
    rows = scope_filter(df, scope, cols)
    if scope.date is not None:
        patterns = region_patterns(rows, regions, [], cols)
    else:
        # over all days an entity is judged by all its appearances together
        rows = rows.filter(F.col(cols.entity).isNotNull())
        patterns = region_lists(rows, [cols.entity], regions, cols=cols).withColumn(
            "entities", F.lit(1).cast("bigint")
        )
    appearances = F.col("_n") * F.col("entities")
    several = (F.size("pattern") > 1).alias("_several")
    return (
        patterns.select(several, "entities", F.inline("pattern").alias(cols.region, "_n"))
        .groupBy(cols.region)
        .agg(
            F.sum(F.when(F.col("_several"), 0).otherwise(appearances)).alias("exclusive"),
            F.sum(F.when(F.col("_several"), appearances).otherwise(0)).alias("shared"),
        )
    )


def cross_region(
    df: DataFrame, scope: Scope, k: int = 30, cols: ChartColumns = CHART
) -> DataFrame:
    """The k videos charting in most regions, with the regions they chart in.

    Ranked on counts per video and region; titles and channels, the widest columns, are
    read for the k winners only.
    """
    rows = scope_filter(df, scope, cols)
    per_video = region_lists(rows, [cols.entity], scope.region_list(), F.col(cols.views), cols=cols)
    candidates = per_video.select(
        cols.entity,
        F.size("pattern").alias("regions"),
        F.array_join("pattern.region", " ").alias("charts"),
        F.col("_max0").alias("views"),
    ).filter("regions > 1")
    order = [F.desc("regions"), F.desc_nulls_last("views")]
    winners = top_k(candidates, order, k, [cols.entity])
    labels = (
        # k rows by construction
        rows.join(F.broadcast(winners.select(cols.entity)), cols.entity, "left_semi")
        .groupBy(cols.entity)
        .agg(F.max(cols.channel).alias("channel"), F.max(cols.title).alias("title"))
    )
    return winners.join(F.broadcast(labels), cols.entity).orderBy(*order, cols.entity)
