"""Queries that look at every day of the chart, on tables of a few hand-written events."""

import pytest

from chartloom.plans.oracle import ORACLE
from chartloom.plans.registry import QUERIES
from compare import connect, differences

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
PARTS = "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


@pytest.fixture
def tables(spark, tmp_path):
    def write(days_of):
        """Tables in which each video has an event on its days."""
        seen = [(video, day) for video, days in days_of.items() for day in days]
        events = [(i, f"{day} 10:00:00", video, "view", 1.0, '{"k": 1}') for i, (video, day) in enumerate(seen)]
        rows = spark.createDataFrame(events, EVENTS.replace("timestamp", "string"))
        rows = rows.withColumn("ts", rows["ts"].cast("timestamp_ntz"))
        rows.coalesce(1).write.parquet(str(tmp_path / "e"))
        parts = spark.createDataFrame([(v, f"name {v}", "Brand#1", ("SMALL", "STANDARD")[v % 2], 1, 1.0) for v in days_of], PARTS)
        parts.coalesce(1).write.parquet(str(tmp_path / "p"))
        for folder, name in (("e", "events"), ("p", "part")):
            (found,) = (tmp_path / folder).glob("*.parquet")
            found.rename(tmp_path / f"{name}.parquet")
        return str(tmp_path)

    return write


def test_a_video_of_any_earlier_day_is_known(spark, tables):
    folder = tables({1: ["2024-01-02", "2024-01-10"], 2: ["2024-01-09", "2024-01-10"], 3: ["2024-01-10"]})
    found = QUERIES["anti_not_exists"](spark, folder)
    assert [r.video_id for r in found.collect()] == ["3"]
    assert differences(found, connect(folder), ORACLE["anti_not_exists"]) == []


def test_one_day_share_counts_all_days(spark, tables):
    folder = tables({1: ["2024-01-02"], 2: ["2024-01-02", "2024-01-20"], 3: ["2024-01-21"], 4: ["2024-01-22"]})
    found = QUERIES["one_day_share"](spark, folder)
    assert [r.one_day_pct for r in found.collect()] == [75.0]
    assert differences(found, connect(folder), ORACLE["one_day_share"]) == []
