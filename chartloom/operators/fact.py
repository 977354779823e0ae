"""The appearance fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions import iso_instant
from chartloom.operators.joins import validity_join
from chartloom.operators.keys import number_rows
from chartloom.operators.lookups import dim_key_resolve

GRAIN = ["video_id", "region_code", "ingest_date"]
# In the order in which a row is held against them.
DIMENSIONS = ("video", "channel", "category", "region", "date")


def resolve_keys(
    staging: DataFrame,
    dim_video: DataFrame,
    dim_channel: DataFrame,
    dim_category: DataFrame,
    dim_region: DataFrame,
    dim_date: DataFrame,
) -> DataFrame:
    """Every staged row with its surrogate keys and the first dimension that has none for it.

    Versioned dimensions are joined on the version valid at the ingest date,
    the others on the natural key.  ``missing`` names the dimension, or is NULL.
    """
    rows = staging.select(
        *GRAIN,
        "channel_id",
        "category_id",
        "view_count",
        "like_count",
        "comment_count",
        "regional_rank",
        iso_instant("pulled_at").alias("pulled_at"),
    )
    rows = validity_join(rows, dim_video, ["video_id"], "ingest_date", ["video_key"], how="left")
    rows = validity_join(rows, dim_channel, ["channel_id"], "ingest_date", ["channel_key"], how="left")
    rows = dim_key_resolve(rows, dim_category, "category_id", "category_key", how="left")
    rows = dim_key_resolve(rows, dim_region, "region_code", "region_key", how="left")
    rows = dim_key_resolve(rows, dim_date, "full_date", "date_key", "ingest_date", how="left")
    missing = F.coalesce(*[F.when(F.col(f"{d}_key").isNull(), F.lit(d)) for d in DIMENSIONS])
    return rows.withColumn("missing", missing)


def fact_rows(resolved: DataFrame) -> DataFrame:
    """The rows of the fact, without a key of their own."""
    return resolved.filter("missing IS NULL").select(
        *[f"{d}_key" for d in DIMENSIONS],
        *GRAIN,
        "view_count",
        "like_count",
        "comment_count",
        "regional_rank",
        "pulled_at",
    )


def rejected_rows(resolved: DataFrame) -> DataFrame:
    """The staged rows that do not reach the fact, and for want of what."""
    return resolved.filter("missing IS NOT NULL").select(*GRAIN, "missing")


def with_fact_keys(rows: DataFrame, loaded: DataFrame | None, start: int) -> DataFrame:
    """Add ``fact_key``: rows that are in ``loaded`` keep theirs, others get the next above ``start``.

    Numbers are handed out in buckets of the grain, so any number of regions,
    videos and dates does.  ``rows`` are read twice.
    """
    if loaded is None:
        return number_rows(rows, GRAIN, "fact_key", start)
    met = rows.join(loaded.select(*GRAIN, "fact_key"), GRAIN, "left")
    fresh = number_rows(met.filter("fact_key IS NULL").drop("fact_key"), GRAIN, "fact_key", start)
    return met.filter("fact_key IS NOT NULL").unionByName(fresh)
