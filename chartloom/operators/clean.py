"""From landed API pages and nested objects to flat, typed chart rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions import to_count
from chartloom.operators.positions import running_offsets
from chartloom.schemas import FLAT_COLUMNS, FLAT_LINE, FLAT_TYPES


def concat_pages(pages: DataFrame, items: str, by: list[str], page: str) -> DataFrame:
    """How many items come before each page when a list's pages are chained."""
    sized = pages.select(*by, page, F.size(items).alias("n_items"))
    return running_offsets(sized, by, page, "n_items", out="first_offset")


def rank_positions(
    pages: DataFrame,
    items: str,
    by: list[str],
    page: str,
    item: str = "item",
    rank: str = "rank",
    pulled_at: Column | None = None,
) -> DataFrame:
    """One row per item with its place in the whole list, counted from 1.

    Offsets are computed on page sizes alone, so the item bodies move once and
    are spread by (list, page).
    """
    offsets = concat_pages(pages, items, by, page).drop("n_items")
    placed = pages.join(offsets, [*by, page]).select(
        *by, "first_offset", F.posexplode(items).alias("_pos", item)
    )
    out = placed.select(
        *by, (F.col("first_offset") + F.col("_pos") + 1).cast("int").alias(rank), item
    )
    return out if pulled_at is None else out.withColumn("pulled_at", pulled_at)


def empty_array_default(df: DataFrame, column: str) -> DataFrame:
    """A missing array becomes an empty one, so the column is never NULL."""
    return df.withColumn(
        column, F.coalesce(F.col(column), F.array().cast(df.schema[column].dataType))
    )


def cast_counts(df: DataFrame, columns: list[str], strict: bool = True) -> DataFrame:
    """Text counters to bigint; NULL stays NULL, malformed text raises if strict."""
    return df.withColumns({c: to_count(F.col(c), strict) for c in columns})


def flatten_nested(raw: DataFrame, region: str = "region_code") -> DataFrame:
    """Nested API objects to the flat chart, apart from the category name."""
    flat = raw.select(
        F.col("id").alias("video_id"),
        F.col("snippet.title").alias("video_title"),
        F.col("snippet.publishedAt").alias("published_at"),
        F.col("snippet.channelId").alias("channel_id"),
        F.col("snippet.channelTitle").alias("channel_title"),
        F.col("snippet.categoryId").alias("category_id"),
        F.col("snippet.tags").alias("video_tags"),
        F.col("statistics.viewCount").alias("view_count"),
        F.col("statistics.likeCount").alias("like_count"),
        F.col("statistics.commentCount").alias("comment_count"),
        F.col("rank").cast("int").alias("regional_rank"),
        "pulled_at",
        F.col(region).alias("region_code"),
        *[c for c in ("ingest_date",) if c in raw.columns],
    )
    counts = ["view_count", "like_count", "comment_count"]
    return empty_array_default(cast_counts(flat, counts), "video_tags")


def flat_values(line: str = "line") -> list[Column]:
    """Typed flat columns out of a parsed chart line struct."""
    values = []
    for name in FLAT_COLUMNS:
        value = F.col(f"{line}.{name}")
        if name == "video_tags":
            value = F.coalesce(value, F.array().cast("array<string>"))
        elif name in FLAT_TYPES:
            value = value.cast(FLAT_TYPES[name])
        values.append(value.alias(name))
    return values


def staging_projection(landing: DataFrame, day: str | dt.date | None = None) -> DataFrame:
    """Landed JSON lines of one day (or of every landed day) as typed rows."""
    if day is not None:
        landing = landing.filter(F.col("ingest_date") == F.lit(str(day)).cast("date"))
    parsed = landing.withColumn(
        "line", F.from_json("data", FLAT_LINE, {"mode": "FAILFAST"})
    )
    return parsed.select(
        *flat_values(), "ingest_date", F.current_timestamp().alias("loaded_at"), "source_file"
    )
