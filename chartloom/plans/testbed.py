"""The chart, its raw landing zone and a warehouse, derived from the driver's tables.

``FIXTURES.md`` defines the derivation.  Each stage is written once per
application and table folder, so queries read what the real ones read: a
chart table in date folders, raw NDJSON by region and date, manifests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chartloom.functions import iso_text
from chartloom.operators.positions import list_positions
from chartloom.operators.scope import Scope
from chartloom.plans.warehouse import Warehouse
from chartloom.schemas import FLAT_COLUMNS
from chartloom.session import scratch_path
from chartloom.sources.files import (
    land_raw,
    path_columns,
    replace_partition,
    scan_flat_partitioned,
    write_ndjson,
)

# Constants of the checked queries.
DAY = "2024-01-10"
REGIONS = ("click", "error", "purchase", "signup", "view")
MIN_VIEWS = 2000
CATEGORY = "SMALL"
ONE_DAY = Scope(DAY, REGIONS)
ALL_DAYS = Scope(None, REGIONS)
CALENDAR = ("2024-01-01", "2024-12-31")
# Days on which the category lookup of the raw zone was fetched.
FETCHES = ("2023-12-31", "2024-01-12", "2024-01-22")
PAGE_SIZE = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derive_appearances(events: DataFrame, part: DataFrame) -> DataFrame:
    """One row per entity, event type and date out of an event stream, with the entity's columns.

    The events collapse by (user, type, date) before any exchange; a user then
    has at most one row per type and day, which bounds the window.
    """
    k = F.get_json_object("props", "$.k").cast("bigint")
    per = events.groupBy(
        "user_id", "event_type", F.to_date("ts").alias("ingest_date")
    ).agg(
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.round(F.col("value") * 100).cast("bigint")).alias("views"),
        F.sum(F.when(k % 10 != 0, k)).alias("likes"),
    )
    first_seen = F.min("first_ts").over(Window.partitionBy("user_id"))
    entity = part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    return per.withColumn("u_first", first_seen).join(entity, F.col("user_id") == F.col("p_partkey"))


def chart_rows(joined: DataFrame, *more: str) -> DataFrame:
    """The flat chart out of appearances, with ``more`` of their columns."""
    retitled = (F.col("user_id") % 7 == 0) & (F.col("ingest_date") >= F.lit("2024-01-16").cast("date"))
    renamed = F.col("p_brand").endswith("3") & (
        F.col("ingest_date") >= F.lit("2024-01-20").cast("date")
    )
    return joined.select(
        *more,
        F.col("user_id").cast("string").alias("video_id"),
        F.concat("p_name", F.when(retitled, " v2").otherwise("")).alias("video_title"),
        iso_text(F.timestamp_add("HOUR", -F.col("p_size"), F.col("u_first"))).alias("published_at"),
        F.col("p_brand").alias("channel_id"),
        F.concat("p_brand", F.when(renamed, " TV").otherwise("")).alias("channel_title"),
        F.col("p_type").alias("category_id"),
        F.when(F.col("p_type") == "PROMO", "UNKNOWN").otherwise(F.col("p_type")).alias("category_name"),
        F.split("p_name", " ").alias("video_tags"),
        F.col("views").alias("view_count"),
        F.col("likes").alias("like_count"),
        F.when(F.col("n") > 1, F.col("n")).alias("comment_count"),
        iso_text("last_ts").alias("pulled_at"),
        F.col("event_type").alias("region_code"),
        "ingest_date",
    )


def ranked_chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived chart with each row's place in its region's list of the day."""
    seen = derive_appearances(table(spark, sf_dir, "events"), table(spark, sf_dir, "part"))
    # texts are made after the rows have moved
    ranked = list_positions(
        seen,
        ["event_type", "ingest_date"],
        [F.desc("views"), F.asc("user_id")],
        "regional_rank",
    )
    place = F.col("regional_rank").cast("int")
    return chart_rows(ranked.withColumn("regional_rank", place), "regional_rank").select(*FLAT_COLUMNS, "ingest_date")


_built: dict[tuple[str, ...], str] = {}


def _stamp(spark: SparkSession, sf_dir: str) -> str:
    """Sizes and times of the source files, so changed tables are derived again."""
    files = [f"{sf_dir.rstrip('/')}/{name}.parquet" for name in ("events", "part")]
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(files)
        .select("path", "length", "modificationTime")
    )
    return str(listing.agg(F.count("*"), F.sum("length"), F.max("modificationTime")).first())


def once(spark: SparkSession, sf_dir: str, label: str, build: Callable[[str], None]) -> str:
    """The path ``build`` wrote for these tables, building it at the first call."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), _stamp(spark, sf_dir), label)
    if key not in _built:
        path = scratch_path(spark, label)
        build(path)
        _built[key] = path
    return _built[key]


def chart_root(spark: SparkSession, sf_dir: str) -> str:
    return once(
        spark, sf_dir, "chart", lambda path: replace_partition(ranked_chart(spark, sf_dir), path)
    )


def chart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chart table, partitioned by ingest date."""
    return scan_flat_partitioned(spark, chart_root(spark, sf_dir))


def processed_root(spark: SparkSession, sf_dir: str) -> str:
    """The same chart as NDJSON in date folders."""
    return once(
        spark, sf_dir, "processed", lambda path: write_ndjson(chart(spark, sf_dir), path)
    )


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return land_raw(spark, processed_root(spark, sf_dir))


def nested(rows: DataFrame) -> DataFrame:
    """Flat chart rows back in the shape of the raw API object."""
    text = lambda name: F.col(name).cast("string")
    return rows.select(
        F.lit("video").alias("kind"),
        F.col("video_id").alias("id"),
        F.struct(
            F.col("video_title").alias("title"),
            F.lit("not kept").alias("description"),
            F.col("published_at").alias("publishedAt"),
            F.col("channel_id").alias("channelId"),
            F.col("channel_title").alias("channelTitle"),
            F.col("category_id").alias("categoryId"),
            F.col("video_tags").alias("tags"),
        ).alias("snippet"),
        F.struct(
            text("view_count").alias("viewCount"),
            text("like_count").alias("likeCount"),
            text("comment_count").alias("commentCount"),
        ).alias("statistics"),
        F.col("regional_rank").alias("rank"),
        "pulled_at",
        F.col("region_code").alias("region"),
        "ingest_date",
    )


def lookup_titles() -> list[Column]:
    """The title of a category in each fetch, NULL where the fetch lacks it.

    PROMO is known to the second one only, which lacks SMALL and writes all in
    lower case; the third renames STANDARD.
    """
    kind = F.col("id")
    return [
        F.when(kind != "PROMO", kind),
        F.when(kind != "SMALL", F.lower(kind)),
        F.when(kind == "STANDARD", "STANDARD 3").when(kind != "PROMO", kind),
    ]


def landing_root(spark: SparkSession, sf_dir: str) -> str:
    """Raw zone: ``raw/region=/ingest_date=`` (compressed) and ``control/ingest_date=``."""

    def build(path: str) -> None:
        rows = nested(chart(spark, sf_dir)).hint("rebalance", F.col("ingest_date"), F.col("region"))
        rows.write.partitionBy("region", "ingest_date").json(f"{path}/raw", compression="gzip")
        write_manifests(spark, path, f"{path}/control")

    return once(spark, sf_dir, "landing", build)


def lookup_root(spark: SparkSession, sf_dir: str) -> str:
    """The category lookups of the raw zone: ``fetched_date=``."""

    def build(path: str) -> None:
        types = table(spark, sf_dir, "part").select(F.col("p_type").alias("id")).distinct()
        for fetched, title in zip(FETCHES, lookup_titles()):
            # an outdated entry of each id comes before the one that counts
            both = types.select("id", F.explode(F.array(F.concat(F.lit("zz "), title), title)).alias("title"))
            entries = both.filter("title IS NOT NULL").withColumn("assignable", F.lit(True))
            entries.coalesce(1).write.json(f"{path}/fetched_date={fetched}")

    return once(spark, sf_dir, "lookup", build)


def delivered(rows: DataFrame) -> DataFrame:
    """The (date, region) folders that hold rows."""
    return rows.select("ingest_date", F.col("region_code").alias("region")).distinct()


def write_manifests(spark: SparkSession, root: str, control: str) -> None:
    """One manifest file per date of a raw zone, naming its files; earlier ones stay."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/raw")
    key = F.concat(F.lit("raw/"), F.regexp_extract("_metadata.file_path", "region=.+$", 0))
    manifests = (
        path_columns(listing.select(key.alias("key"), "_metadata"), {"ingest_date": "string"})
        .groupBy(F.col("ingest_date").alias("date"))
        .agg(F.array_sort(F.collect_list("key")).alias("regions"))
        .withColumn("ingest_date", F.col("date"))
    )
    spread = manifests.hint("rebalance", F.col("ingest_date"))
    spread.write.mode("append").partitionBy("ingest_date").json(control)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chart as landed API pages: fixed-size runs of a list, items in order."""
    page = F.floor((F.col("regional_rank") - 1) / PAGE_SIZE).cast("int")
    item = F.struct("regional_rank", "video_id")
    return (
        chart(spark, sf_dir)
        .groupBy("region_code", "ingest_date", page.alias("page_no"))
        .agg(F.array_sort(F.collect_list(item)).alias("ordered"))
        .select("region_code", "ingest_date", "page_no", F.col("ordered.video_id").alias("items"))
    )


def region_seeds() -> list[tuple[str, str]]:
    return [(code, code.capitalize()) for code in REGIONS]


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse with every day of the chart loaded in one backfill."""

    def build(path: str) -> None:
        Warehouse(spark, path, region_seeds(), CALENDAR).backfill(chart(spark, sf_dir))

    root = once(spark, sf_dir, "warehouse", build)
    return Warehouse(spark, root, region_seeds(), CALENDAR)
