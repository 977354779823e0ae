"""Entity-to-tag links: latest state only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.operators.joins import seen_today


def staged_links(staging: DataFrame) -> DataFrame:
    """Distinct (video, tag) pairs of the staged rows; a NULL in a list is no tag."""
    pairs = staging.select("video_id", F.explode("video_tags").alias("tag_name"))
    return pairs.filter("tag_name IS NOT NULL").distinct()


def bridge_rows(staging: DataFrame, versions: DataFrame, dim_tag: DataFrame) -> DataFrame:
    """All links of each staged video as one row: its open version and its tags' keys.

    One row replaces whatever links a video had, so nothing has to be looked up
    or removed; a video without tags has an empty list.
    """
    links = (
        staged_links(staging)
        .join(dim_tag.select("tag_name", "tag_key"), "tag_name")
        .groupBy("video_id")
        .agg(F.array_sort(F.collect_set("tag_key")).alias("tag_keys"))
    )
    open_versions = versions.filter("is_current").select("video_id", "video_key")
    none = F.array().cast("array<bigint>")
    return (
        staging.select("video_id")
        .distinct()
        .join(open_versions, "video_id")
        .join(links, "video_id", "left")
        .select("video_id", "video_key", F.coalesce("tag_keys", none).alias("tag_keys"))
    )


def bridge_links(rows: DataFrame) -> DataFrame:
    """The bridge itself: one (video_key, tag_key) per link."""
    return rows.select("video_key", F.explode("tag_keys").alias("tag_key"))


def bridge_refresh(
    bridge: DataFrame, staging: DataFrame, dim_video: DataFrame, dim_tag: DataFrame
) -> DataFrame:
    """Replace the links of today's videos; links of other videos stay.

    Links to every version of a staged video go, and its staged tags are
    linked to its open version.  ``dim_tag`` must already hold today's tags.
    """
    stale = seen_today(dim_video.select("video_id", "video_key"), staging, "video_id")
    untouched = bridge.join(stale.select("video_key"), "video_key", "left_anti")
    open_versions = dim_video.filter("is_current").select("video_id", "video_key")
    # the pairs are distinct and both lookups are one-to-one, so are the links
    fresh = (
        staged_links(staging)
        .join(open_versions, "video_id")
        .join(dim_tag.select("tag_name", "tag_key"), "tag_name")
        .select("video_key", "tag_key")
    )
    return untouched.unionByName(fresh)
