"""Tags, like rates, leading rows and channels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions import rate
from chartloom.operators.joins import explode_tags
from chartloom.operators.scope import Scope, scope_filter
from chartloom.operators.topk import top_k
from chartloom.schemas import CHART, ChartColumns


def top_tags(
    df: DataFrame, scope: Scope = Scope(), k: int = 12, cols: ChartColumns = CHART
) -> DataFrame:
    """The k most used tags, lowercased so that one tag counts once."""
    uses = (
        explode_tags(scope_filter(df, scope, cols).select(cols.tags), cols.tags)
        .groupBy(F.lower("tag").alias("tag"))
        .agg(F.count(F.lit(1)).alias("uses"))
    )
    return top_k(uses, [F.desc("uses")], k, ["tag"])


def like_rate(
    df: DataFrame,
    scope: Scope = Scope(),
    min_views: int = 10_000,
    k: int = 40,
    cols: ChartColumns = CHART,
) -> DataFrame:
    """The k rows with most likes per view, above ``min_views`` and with likes known."""
    rated = (
        scope_filter(df, scope, cols)
        .filter((F.col(cols.views) > min_views) & F.col(cols.likes).isNotNull())
        .select(
            cols.entity,
            cols.title,
            cols.channel,
            cols.region,
            cols.date,
            cols.views,
            cols.likes,
            F.round(rate(F.col(cols.likes), F.col(cols.views)), 2).alias("like_rate"),
        )
    )
    return top_k(rated, [F.desc("like_rate")], k, [cols.entity, cols.region, cols.date])


def top_ranked(
    df: DataFrame, scope: Scope = Scope(), max_rank: int = 5, cols: ChartColumns = CHART
) -> DataFrame:
    """The leading rows of each region's chart."""
    return (
        scope_filter(df, scope, cols)
        .filter(F.col(cols.rank) <= max_rank)
        .select(cols.date, cols.region, cols.rank, cols.views, cols.channel, cols.title)
        .orderBy(cols.date, cols.region, cols.rank)
    )


def top_channels(
    df: DataFrame, scope: Scope = Scope(), k: int = 15, cols: ChartColumns = CHART
) -> DataFrame:
    """The k channels with most rows, their regions and total views."""
    held = (
        scope_filter(df, scope, cols)
        .groupBy(cols.channel)
        .agg(
            F.count(F.lit(1)).alias("appearances"),
            F.count_distinct(cols.region).alias("regions"),
            F.sum(cols.views).alias("total_views"),
        )
    )
    order = [F.desc("appearances"), F.desc_nulls_last("total_views")]
    return top_k(held, order, k, [cols.channel])


def concentration(
    df: DataFrame, scope: Scope = Scope(), k: int = 10, cols: ChartColumns = CHART
) -> DataFrame:
    """Rows held by the k largest channels, all rows, and the percentage.

    Which of several equal channels is k-th does not change the sum, so a
    top-k limit replaces a global numbering of all channels.
    """
    held = (
        scope_filter(df, scope, cols)
        .groupBy(cols.channel)
        .agg(F.count(F.lit(1)).alias("appearances"))
    )
    leading = top_k(held, [F.desc("appearances")], k, [cols.channel])
    sums = leading.select(
        F.col("appearances").alias("lead"), F.lit(0).cast("bigint").alias("every")
    ).unionAll(held.select(F.lit(0).cast("bigint"), F.col("appearances")))
    return sums.agg(F.sum("lead").alias("top10_rows"), F.sum("every").alias("all_rows")).withColumn(
        "share_pct", rate(F.col("top10_rows"), F.col("all_rows"))
    )


def persistent_channels(
    df: DataFrame, scope: Scope = Scope(), k: int = 15, cols: ChartColumns = CHART
) -> DataFrame:
    """The k channels charting on most days.

    Days and rows come from counts by (channel, date), which collapse before
    the exchange; distinct videos, the costly count, for the winners only.
    """
    rows = scope_filter(df, scope.all_days(), cols)
    daily = rows.groupBy(cols.channel, cols.date).agg(F.count(F.lit(1)).alias("_n"))
    held = daily.groupBy(cols.channel).agg(
        F.count(F.lit(1)).alias("days"), F.sum("_n").alias("appearances")
    )
    order = [F.desc("days"), F.desc("appearances")]
    winners = top_k(held, order, k, [cols.channel])
    same = lambda: F.col(cols.channel).eqNullSafe(F.col("_winner"))
    keys = winners.select(F.col(cols.channel).alias("_winner"))
    videos = (
        rows.select(cols.channel, cols.entity)
        .join(F.broadcast(keys), same(), "left_semi")
        .groupBy(F.col(cols.channel).alias("_winner"))
        .agg(F.count_distinct(cols.entity).alias("videos"))
    )
    return (
        winners.join(F.broadcast(videos), same())
        .select(cols.channel, "days", "videos", "appearances")
        .orderBy(*order, cols.channel)
    )
