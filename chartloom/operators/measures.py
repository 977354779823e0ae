"""Valid uses of the counters.

Counters are cumulative since publication and global to the entity: adding
them over days, over regions, or through the tag bridge counts them twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.operators.joins import validity_join
from chartloom.schemas import CHART, ChartColumns


def semi_additive_last(
    df: DataFrame, period: Column, measure: str = "view_count", cols: ChartColumns = CHART
) -> DataFrame:
    """The counter as last observed in each period, per entity and region."""
    return df.groupBy(cols.entity, cols.region, period.alias("period")).agg(
        F.max(cols.date).alias("last_date"), F.max_by(measure, cols.date).alias(measure)
    )


def counter_delta(
    df: DataFrame, measure: str = "view_count", cols: ChartColumns = CHART
) -> DataFrame:
    """Counter growth between consecutive observed days of an entity.

    The window holds one row per day an entity was observed.
    """
    daily = df.groupBy(cols.entity, cols.date).agg(F.max(measure).alias(measure))
    by_entity = Window.partitionBy(cols.entity).orderBy(cols.date)
    return daily.select(
        cols.entity,
        cols.date,
        measure,
        F.lag(cols.date).over(by_entity).alias("previous_date"),
        (F.col(measure) - F.lag(measure).over(by_entity)).alias("delta"),
    )


def dedup_region_sum(
    df: DataFrame, measure: str = "view_count", cols: ChartColumns = CHART
) -> DataFrame:
    """Daily total that counts each entity once, not once per region."""
    daily = df.groupBy(cols.date, cols.entity).agg(F.max(measure).alias("_once"))
    return daily.groupBy(cols.date).agg(
        F.count(F.lit(1)).alias("videos"), F.sum("_once").alias("total")
    )


def tag_fanout_safe(
    df: DataFrame, measure: str = "view_count", cols: ChartColumns = CHART
) -> DataFrame:
    """Per date and tag the entities carrying it and their counter, each entity once per tag.

    The row with a NULL tag is the date's grand total before the fan-out, which
    the tag rows exceed by design.  One read: the rows of an entity and day
    meet once, and what comes out feeds its tags and the total alike.
    """
    once = df.groupBy(cols.date, cols.entity).agg(
        F.max(measure).alias("_once"), F.collect_set(cols.tags).alias("_lists")
    )
    # a NULL in a list is no tag
    tags = F.filter(F.array_distinct(F.flatten("_lists")), lambda tag: tag.isNotNull())
    total = F.array(F.lit(None).cast("string"))
    return (
        once.select(cols.date, "_once", F.explode(F.concat(tags, total)).alias("tag"))
        .groupBy(cols.date, "tag")
        .agg(F.count(F.lit(1)).alias("videos"), F.sum("_once").alias("total"))
    )


def retitle_effect(
    facts: DataFrame,
    versions: DataFrame,
    measure: str = "view_count",
    cols: ChartColumns = CHART,
) -> DataFrame:
    """Mean daily counter and best rank under each title version, and the change.

    Covers entities with more than one version that was seen charting.  Each
    entity counts once per day; the window holds one row per version.
    """
    daily = facts.groupBy(cols.entity, cols.date).agg(
        F.max(measure).alias("_value"), F.min(cols.rank).alias("_rank")
    )
    placed = validity_join(
        daily, versions.withColumn("_since", F.col("valid_from")), [cols.entity], cols.date,
        ["_since", cols.title],
    )
    per_version = placed.groupBy(cols.entity, "_since", cols.title).agg(
        F.count(F.lit(1)).alias("days"),
        F.avg("_value").alias("avg_value"),
        F.min("_rank").alias("best_rank"),
    )
    by_entity = Window.partitionBy(cols.entity)
    in_order = by_entity.orderBy("_since")
    return (
        per_version.withColumn("_versions", F.count(F.lit(1)).over(by_entity))
        .withColumn("version_no", F.row_number().over(in_order))
        .withColumn("avg_change", F.col("avg_value") - F.lag("avg_value").over(in_order))
        .filter("_versions > 1")
        .select(
            cols.entity,
            "version_no",
            F.col("_since").alias("valid_from"),
            cols.title,
            "days",
            "avg_value",
            "best_rank",
            "avg_change",
        )
    )
