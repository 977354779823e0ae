"""Long results into the wide and long shapes reports want.

The inputs are reports already, one row per group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def overlap_matrix(
    pairs: DataFrame, regions: tuple[str, ...], value: str = "shared"
) -> DataFrame:
    """Region pairs as a square matrix in the given region order, 0 where missing."""
    wide = (
        pairs.groupBy("region_a")
        .pivot("region_b", list(regions))
        .agg(F.first(value).cast("bigint"))
    )
    every = wide.sparkSession.createDataFrame(
        [(i, r) for i, r in enumerate(regions)], "_place int, region_a string"
    )
    return (
        every.join(wide, "region_a", "left")
        .orderBy("_place")
        .select("region_a", *[F.coalesce(F.col(f"`{r}`"), F.lit(0)).alias(r) for r in regions])
    )


def publish_hour_grid(hours: DataFrame, category: str = "category_name") -> DataFrame:
    """Category by hour of day, columns h00 to h23, 0 where missing."""
    wide = hours.groupBy(category).pivot("publish_hour", list(range(24))).agg(F.sum("videos"))
    return wide.select(
        category, *[F.coalesce(F.col(f"`{h}`"), F.lit(0)).alias(f"h{h:02d}") for h in range(24)]
    )


def exclusive_shared_long(split: DataFrame, region: str = "region_code") -> DataFrame:
    """One row per region and kind."""
    return split.unpivot([region], ["exclusive", "shared"], "kind", "videos")


def union_regions(parts: list[DataFrame]) -> DataFrame:
    """Append regional frames into one."""
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole
