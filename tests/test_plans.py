"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from chartloom.operators import engagement, history, joins, lookups, measures, mix, overlap, overview, scd
from chartloom.operators.scope import scope_filter
from chartloom.plans import testbed as tb
from chartloom.schemas import CATEGORY_LOOKUP

OPERATORS = {
    "overview": lambda c: overview.overview(c, tb.ALL_DAYS),
    "spread": lambda c: overview.spread(c, tb.ALL_DAYS),
    "category_mix": lambda c: mix.category_mix(c, tb.ALL_DAYS),
    "chart_size": lambda c: overview.chart_size(c, tb.ALL_DAYS),
    "avg_daily_overlap": lambda c: overlap.avg_daily_overlap(c, tb.ALL_DAYS),
    "exclusive_shared": lambda c: overlap.exclusive_shared(c, tb.ALL_DAYS),
    "hours_to_trend": lambda c: mix.hours_to_trend(c, tb.ALL_DAYS),
    "publish_hour": lambda c: mix.publish_hour(c, tb.ALL_DAYS),
    "top_tags": lambda c: engagement.top_tags(c, tb.ALL_DAYS),
    "cross_region": lambda c: overlap.cross_region(c, tb.ALL_DAYS),
    "top_channels": lambda c: engagement.top_channels(c, tb.ALL_DAYS),
    "concentration": lambda c: engagement.concentration(c, tb.ALL_DAYS),
    "daily_churn": lambda c: history.daily_churn(c, tb.ALL_DAYS),
    "staying_power": lambda c: history.staying_power(c, tb.ALL_DAYS),
    "persistent_channels": lambda c: engagement.persistent_channels(c, tb.ALL_DAYS),
    "dedup_region_sum": measures.dedup_region_sum,
    "counter_delta": measures.counter_delta,
    "versions": lambda c: scd.scd2_from_history(c, ["video_id"], ["video_title"], "ingest_date"),
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", OPERATORS)
def test_no_python_and_no_cross_join(name, rows):
    text = plan(OPERATORS[name](rows))
    for unwanted in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "NestedLoopJoin"):
        assert unwanted not in text


@pytest.mark.parametrize("name", OPERATORS)
def test_single_partitions_hold_aggregates_only(name, rows):
    """Whatever gathers into one task has been aggregated before."""
    lines = plan(OPERATORS[name](rows)).splitlines()
    for number, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = "\n".join(lines[number + 1 :])
            assert "HashAggregate" in below.split("FileScan")[0]


def test_scope_prunes_folders_and_columns(rows):
    text = plan(overview.chart_size(rows, tb.ONE_DAY))
    assert "PartitionFilters: [isnotnull(ingest_date" in text and tb.DAY in text
    schema = text.split("ReadSchema: ")[1].splitlines()[0]
    assert schema == "struct<view_count:bigint,region_code:string>"
    scanned = scope_filter(rows, tb.ONE_DAY)
    assert scanned.rdd.getNumPartitions() < rows.rdd.getNumPartitions()


def test_region_and_threshold_reach_the_scan(rows):
    text = plan(engagement.like_rate(rows, tb.ONE_DAY, 2000))
    pushed = text.split("PushedFilters: ")[1].splitlines()[0]
    assert "In(region_code" in pushed and "GreaterThan(view_cou" in pushed
    assert "TakeOrderedAndProject" in text


def test_overlap_reads_once_and_joins_nothing(rows):
    text = plan(overlap.avg_daily_overlap(rows, tb.ALL_DAYS))
    assert text.count("FileScan") == 1 and "Join" not in text


def test_churn_reads_once_and_joins_nothing(rows):
    text = plan(joins.join_previous_day(rows, "video_id", "ingest_date"))
    assert text.count("FileScan") == 1 and "Join" not in text
    assert text.count("Exchange hashpartitioning") == 1


def test_small_lookup_is_broadcast_by_size(spark, rows, tmp_path):
    lookup = str(tmp_path / "lookup")
    spark.createDataFrame([("PROMO", "Promo", True)], CATEGORY_LOOKUP).write.json(lookup)
    known = spark.read.schema(CATEGORY_LOOKUP).json(lookup)
    text = plan(lookups.lookup_join(rows.drop("category_name"), known, "category_id", "title"))
    assert "BroadcastHashJoin" in text


def test_large_lookup_is_not_broadcast(spark, rows):
    # nothing forces a broadcast once the planner sees a large side
    large = spark.range(50_000_000).select(
        F.col("id").cast("string").alias("id"), F.col("id").cast("string").alias("title")
    )
    text = plan(lookups.lookup_join(rows.drop("category_name"), large, "category_id", "title"))
    assert "BroadcastHashJoin" not in text


def test_top_k_per_group_limits_before_the_exchange(rows):
    from chartloom.operators.topk import top_k_per_group

    text = plan(top_k_per_group(rows, ["region_code"], [F.desc("view_count")], 5))
    assert text.count("WindowGroupLimit") == 2
