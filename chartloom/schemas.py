"""Schemas of the data at rest and the column names operators work on."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class ChartColumns:
    """Column roles of a flat chart table; pass your own to rename them."""

    entity: str = "video_id"
    title: str = "video_title"
    published_at: str = "published_at"
    channel_id: str = "channel_id"
    channel: str = "channel_title"
    category_id: str = "category_id"
    category: str = "category_name"
    tags: str = "video_tags"
    views: str = "view_count"
    likes: str = "like_count"
    comments: str = "comment_count"
    rank: str = "regional_rank"
    pulled_at: str = "pulled_at"
    region: str = "region_code"
    date: str = "ingest_date"


CHART = ChartColumns()

_S = T.StringType()


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, _S) for name in names]


# Raw API object.  Every leaf is a string: counters arrive as "12" or 12 and a
# bigint schema would turn the quoted form into NULL without an error.
RAW_VIDEO = T.StructType(
    [
        T.StructField("id", _S),
        T.StructField(
            "snippet",
            T.StructType(
                _strings("title", "publishedAt", "channelId", "channelTitle", "categoryId")
                + [T.StructField("tags", T.ArrayType(_S))]
            ),
        ),
        T.StructField(
            "statistics", T.StructType(_strings("viewCount", "likeCount", "commentCount"))
        ),
        T.StructField("rank", _S),
        T.StructField("pulled_at", _S),
    ]
)

CATEGORY_LOOKUP = T.StructType(
    _strings("id", "title") + [T.StructField("assignable", T.BooleanType())]
)

# Completion record of one day: the keys written by that run, and only those.
MANIFEST = T.StructType([T.StructField("date", _S), T.StructField("regions", T.ArrayType(_S))])

# One line of the processed chart file, again read as strings and cast later.
FLAT_LINE = T.StructType(
    _strings(
        "video_id",
        "video_title",
        "published_at",
        "channel_id",
        "channel_title",
        "category_id",
        "category_name",
    )
    + [T.StructField("video_tags", T.ArrayType(_S))]
    + _strings(
        "view_count", "like_count", "comment_count", "regional_rank", "pulled_at", "region_code"
    )
)

FLAT_TYPES: dict[str, T.DataType] = {
    "view_count": T.LongType(),
    "like_count": T.LongType(),
    "comment_count": T.LongType(),
    "regional_rank": T.IntegerType(),
}

FLAT_COLUMNS = [field.name for field in FLAT_LINE.fields]

# The chart table at rest, partitioned by its last column.
FLAT_TABLE = T.StructType(
    [
        T.StructField(f.name, FLAT_TYPES.get(f.name, f.dataType))
        for f in FLAT_LINE.fields
    ]
    + [T.StructField("ingest_date", T.DateType())]
)
