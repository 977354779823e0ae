"""Dimensions whose content is known in advance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.operators.keys import number_rows


def calendar_rows(spans: DataFrame, start: Column | str, end: Column | str) -> DataFrame:
    """One row per day of each span of ``spans``, with its calendar parts."""
    days = spans.select(F.explode(F.sequence(start, end)).alias("full_date")).distinct()
    day = F.col("full_date")
    return days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        "full_date",
        F.year(day).cast("smallint").alias("year"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.month(day).cast("smallint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).cast("smallint").alias("day_of_month"),
        # Sunday is 0
        (F.dayofweek(day) - 1).cast("smallint").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
    )


def calendar_dim(spark: SparkSession, start: str, end: str) -> DataFrame:
    """The calendar from ``start`` to ``end``, both included."""
    span = spark.range(1).select(
        F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end")
    )
    return calendar_rows(span, "start", "end")


def insert_absent(existing: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """``existing`` plus those ``rows`` whose key it lacks; nothing is overwritten."""
    fresh = rows.join(existing.select(*keys), keys, "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def absent_tags(dim_tag: DataFrame, staging: DataFrame, start: int) -> DataFrame:
    """The staged tags ``dim_tag`` does not know yet, spelled as given, with keys."""
    tags = staging.select(F.explode("video_tags").alias("tag_name")).distinct()
    fresh = tags.filter(F.col("tag_name").isNotNull()).join(
        dim_tag.select("tag_name"), "tag_name", "left_anti"
    )
    return number_rows(fresh, ["tag_name"], "tag_key", start).select(*dim_tag.columns)


def insert_absent_tags(dim_tag: DataFrame, staging: DataFrame, start: int) -> DataFrame:
    """``dim_tag`` plus the staged tags it lacks; known tags keep their keys."""
    return dim_tag.unionByName(absent_tags(dim_tag, staging, start))
