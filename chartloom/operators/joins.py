"""Joins over time and membership."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.schemas import CHART, ChartColumns


def validity_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: list[str],
    date: str,
    take: list[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    how: str = "inner",
) -> DataFrame:
    """Each fact with the dimension version valid on its date.

    A version covers ``[valid_from, valid_to)``; an open one has no end.  The
    keys are an equi-join, the period is a residual test, so a hot key is a
    skewed partition that AQE splits on the fact side.
    """
    versions = dim.select(
        *[F.col(k).alias(f"_v_{k}") for k in keys],
        F.col(valid_from).alias("_v_from"),
        F.col(valid_to).alias("_v_to"),
        *take,
    )
    condition = reduce(
        lambda a, b: a & b,
        [F.col(k) == F.col(f"_v_{k}") for k in keys],
        (F.col("_v_from") <= F.col(date))
        & (F.col("_v_to").isNull() | (F.col("_v_to") > F.col(date))),
    )
    return facts.join(versions, condition, how).drop(*[f"_v_{k}" for k in keys], "_v_from", "_v_to")


def seen_today(df: DataFrame, staging: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose entity occurs in the staged day."""
    return df.join(staging.select(key).distinct(), key, "left_semi")


def without_current(
    batch: DataFrame, dim: DataFrame, keys: list[str], current: str = "is_current"
) -> DataFrame:
    """Batch rows whose key has no open version."""
    return batch.join(dim.filter(F.col(current)).select(*keys), keys, "left_anti")


def join_previous_day(
    df: DataFrame, entity: str, date: str, days: int = 1, out: str = "seen_before"
) -> DataFrame:
    """Distinct (date, entity) with whether it was there ``days`` calendar days earlier.

    Every appearance votes for its own day and for the day it is the
    predecessor of; one aggregation by (date, entity) settles both.  That is
    the left self-join with a single exchange, and repeats of an appearance
    collapse before it.
    """
    votes = F.array(
        F.struct(F.col(date).alias("day"), F.lit(True).alias("here")),
        F.struct(F.date_add(date, days).alias("day"), F.lit(False).alias("here")),
    )
    return (
        df.select(entity, F.explode(votes).alias("vote"))
        .groupBy(F.col("vote.day").alias(date), entity)
        .agg(F.max("vote.here").alias("_here"), F.min("vote.here").alias("_only_here"))
        .filter("_here")
        .select(date, entity, (~F.col("_only_here") & F.col(entity).isNotNull()).alias(out))
    )


def keep_top_groups(df: DataFrame, group: str, k: int) -> DataFrame:
    """Rows of the k groups with most rows (ties by name)."""
    largest = (
        df.filter(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("_n"))
        .orderBy(F.desc("_n"), group)
        .limit(k)
        .select(group)
    )
    # k rows by construction
    return df.join(F.broadcast(largest), group, "left_semi")


def explode_tags(df: DataFrame, tags: str = "video_tags", out: str = "tag") -> DataFrame:
    """One row per array element; rows with an empty or NULL array drop out."""
    return df.withColumn(out, F.explode(tags)).drop(tags)


def region_lists(
    rows: DataFrame, group: list[str], regions: tuple[str, ...], *more: Column, cols: ChartColumns = CHART
) -> DataFrame:
    """Per group the regions it has rows in, as a sorted list of (region, n).

    Rows collapse per (group, region) before any exchange, and again per group:
    neither the plan nor the state grows with the number of regions asked for,
    only with those a group is in.  ``more`` are maxima to take along.
    """
    counted = (
        rows.filter(F.col(cols.region).isin(*regions))
        .groupBy(*group, F.col(cols.region).alias("region"))
        .agg(F.count(F.lit(1)).alias("n"), *[F.max(c) for c in more])
    )
    taken = counted.columns[len(group) + 2 :]
    pattern = F.array_sort(F.collect_list(F.struct("region", "n"))).alias("pattern")
    maxima = [F.max(F.col(f"`{t}`")).alias(f"_max{i}") for i, t in enumerate(taken)]
    return counted.groupBy(*group).agg(pattern, *maxima)


def region_patterns(
    rows: DataFrame, regions: tuple[str, ...], by: list[str], cols: ChartColumns = CHART
) -> DataFrame:
    """How many entities share each list of regions and counts, per ``by``.

    Everything about regional overlap follows from this small table, because
    entities with the same list contribute the same.
    """
    # an entity is an appearance on one day; NULL never equals itself in a join
    present = rows.filter(F.col(cols.entity).isNotNull())
    entities = region_lists(present, [cols.date, cols.entity], regions, cols=cols)
    return entities.groupBy(*by, "pattern").agg(F.count(F.lit(1)).alias("entities"))


def pair_counts(
    df: DataFrame, regions: tuple[str, ...], by: list[str], cols: ChartColumns = CHART
) -> DataFrame:
    """Ordered region pairs (diagonal included) with the entities they share.

    Same numbers as joining the chart to itself on (date, entity), without the
    join: pairs are formed from the pattern table, not from the rows.
    """
    patterns = region_patterns(df, regions, by, cols)
    left = patterns.select("*", F.inline("pattern").alias("region_a", "count_a"))
    return (
        left.select("*", F.inline("pattern").alias("region_b", "count_b"))
        .groupBy(*by, "region_a", "region_b")
        .agg(F.sum(F.col("count_a") * F.col("count_b") * F.col("entities")).alias("shared"))
    )
