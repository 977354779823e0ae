"""Hand-written rows."""

from __future__ import annotations

import datetime as dt
import json
import os

from chartloom.schemas import FLAT_TABLE


def date(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def appearance(video="v1", region="AA", day="2024-03-01", **changes) -> tuple:
    row = {
        "video_id": video,
        "video_title": f"title of {video}",
        "published_at": "2024-02-28T10:59:00Z",
        "channel_id": "c1",
        "channel_title": "channel one",
        "category_id": "10",
        "category_name": "Music",
        "video_tags": ["red", "blue"],
        "view_count": 100,
        "like_count": 10,
        "comment_count": 1,
        "regional_rank": 1,
        "pulled_at": f"{day}T18:00:00Z",
        "region_code": region,
        "ingest_date": date(day),
        **changes,
    }
    return tuple(row[name] for name in FLAT_TABLE.names)


def chart_of(spark, appearances):
    return spark.createDataFrame(list(appearances), FLAT_TABLE)


def write_lines(path, objects) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        for item in objects:
            out.write((item if isinstance(item, str) else json.dumps(item)) + "\n")
    return str(path)


def raw_object(video="v1", **changes) -> dict:
    return {
        "kind": "video",
        "id": video,
        "snippet": {
            "title": f"title of {video}",
            "description": "dropped",
            "publishedAt": "2024-02-28T10:59:00Z",
            "channelId": "c1",
            "channelTitle": "channel one",
            "categoryId": "10",
            "tags": ["red", "blue"],
        },
        "statistics": {"viewCount": "100", "likeCount": "10", "commentCount": "1"},
        "rank": 1,
        "pulled_at": "2024-03-01T18:00:00Z",
        **changes,
    }


def as_set(df, *columns) -> set[tuple]:
    return {tuple(r) for r in (df.select(*columns) if columns else df).collect()}
