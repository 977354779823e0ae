"""Named queries: every operator applied to the whole of the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.functions import iso_text
from chartloom.operators import (
    bridge,
    calendar,
    checks,
    clean,
    engagement,
    fact,
    history,
    joins,
    keys,
    lookups,
    measures,
    mix,
    overlap,
    overview,
    reshape,
    scd,
    topk,
)
from chartloom.operators.scope import available_dates, scope_filter
from chartloom.plans import testbed as tb
from chartloom.plans.warehouse import Warehouse, unprocessed_batches
from chartloom.schemas import FLAT_COLUMNS, FLAT_LINE, RAW_VIDEO
from chartloom.session import configure, materialize, scratch_path
from chartloom.sources import files, manifests
from chartloom.streaming import manifests as stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# A day on which titles change in the derived chart.
RETITLE_DAY = "2024-01-16"


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        QUERIES[name] = run
        return build

    return register


def on_chart(name: str, build: Callable[[DataFrame], DataFrame]) -> None:
    """Register a query that needs nothing but the chart table."""
    query(name)(lambda spark, sf_dir: build(tb.chart(spark, sf_dir)))


def plain(df: DataFrame) -> DataFrame:
    """Tags as one string, so that results compare by value."""
    return df.withColumn("video_tags", F.array_join("video_tags", " "))


def until(df: DataFrame, day: str, strictly: bool = False) -> DataFrame:
    limit = F.lit(day).cast("date")
    date = F.col("ingest_date")
    return df.filter(date < limit if strictly else date <= limit)


def day_of(df: DataFrame, day: str) -> DataFrame:
    return df.filter(F.col("ingest_date") == F.lit(day).cast("date"))


# -- sources and sinks ----------------------------------------------------


@query("scan_ndjson")
def _(spark, sf_dir):
    # the folders add ingest_date, which the lines do not hold
    lines = files.scan_ndjson(spark, tb.processed_root(spark, sf_dir), FLAT_LINE)
    line = F.struct(*FLAT_COLUMNS).alias("line")
    return plain(lines.select(line, "ingest_date").select(*clean.flat_values(), "ingest_date"))


@query("scan_flat_partitioned")
def _(spark, sf_dir):
    return plain(day_of(files.scan_flat_partitioned(spark, tb.chart_root(spark, sf_dir)), tb.DAY))


@query("path_columns")
def _(spark, sf_dir):
    raw = spark.read.schema(RAW_VIDEO).json(
        f"{tb.landing_root(spark, sf_dir)}/raw", recursiveFileLookup=True, mode="FAILFAST"
    )
    return files.path_columns(raw, {"region": "string", "ingest_date": "date"}).select(
        "id", "region", "ingest_date"
    )


@query("scan_manifest_batch")
def _(spark, sf_dir):
    root = tb.landing_root(spark, sf_dir)
    return manifests.scan_manifest_batch(spark, f"{root}/control", root).select(
        "id", "snippet.title", "statistics.viewCount", "rank", "region", "ingest_date"
    )


@query("completeness_gate")
def _(spark, sf_dir):
    return manifests.completeness_gate(
        tb.delivered(tb.chart(spark, sf_dir)), list(tb.REGIONS)
    )


@query("raw_landing")
def _(spark, sf_dir):
    names = ["video_id", "region_code", "view_count"]
    line = F.from_json("data", ", ".join(f"{name} string" for name in names)).alias("line")
    return tb.landed(spark, sf_dir).select(line, "ingest_date").select("line.*", "ingest_date")


@query("sink_ndjson")
def _(spark, sf_dir):
    path = scratch_path(spark, "ndjson")
    files.write_ndjson(tb.chart(spark, sf_dir), path)
    # writing again replaces the same folders
    files.write_ndjson(tb.chart(spark, sf_dir), path)
    rows = clean.staging_projection(files.land_raw(spark, path))
    return plain(rows.drop("loaded_at", "source_file"))


@query("sink_partition_replace")
def _(spark, sf_dir):
    path = scratch_path(spark, "replaced")
    rows = tb.chart(spark, sf_dir)
    files.replace_partition(rows, path)
    corrected = day_of(rows, tb.DAY).withColumn("view_count", F.col("view_count") + 1)
    files.replace_partition(corrected, path)
    return history.daily_totals(spark.read.parquet(path))


# -- projection, filter, cleaning -----------------------------------------


@query("rank_positions")
def _(spark, sf_dir):
    return clean.rank_positions(
        tb.pages(spark, sf_dir), "items", ["region_code", "ingest_date"], "page_no", "video_id"
    )


@query("concat_pages")
def _(spark, sf_dir):
    return clean.concat_pages(
        tb.pages(spark, sf_dir), "items", ["region_code", "ingest_date"], "page_no"
    )


def raw_rows(spark, sf_dir):
    root = tb.landing_root(spark, sf_dir)
    return manifests.scan_manifest_batch(spark, f"{root}/control", root)


def lookup_rows(spark, sf_dir):
    return files.scan_category_lookup(spark, tb.lookup_root(spark, sf_dir), tb.DAY)


def lookup_history(spark, sf_dir):
    return files.scan_lookup_versions(spark, tb.lookup_root(spark, sf_dir))


@query("flatten_nested")
def _(spark, sf_dir):
    return plain(clean.flatten_nested(raw_rows(spark, sf_dir), "region"))


@query("cast_counts")
def _(spark, sf_dir):
    counts = ["viewCount", "likeCount", "commentCount"]
    rows = raw_rows(spark, sf_dir).select("id", "region", "ingest_date", "statistics.*")
    return clean.cast_counts(rows, counts)


@query("array_default_empty")
def _(spark, sf_dir):
    sparse = tb.chart(spark, sf_dir).withColumn(
        "video_tags", F.when(F.col("video_id").cast("bigint") % 5 != 0, F.col("video_tags"))
    )
    return clean.empty_array_default(sparse, "video_tags").select(
        "video_id", "region_code", "ingest_date", F.size("video_tags").alias("n_tags")
    )


@query("staging_projection")
def _(spark, sf_dir):
    staged = clean.staging_projection(tb.landed(spark, sf_dir))
    return plain(staged.drop("loaded_at", "source_file"))


on_chart("scope_filter", lambda c: plain(scope_filter(c, tb.ONE_DAY)))
on_chart("available_dates", available_dates)


# -- joins ----------------------------------------------------------------


@query("lookup_join_default")
def _(spark, sf_dir):
    return manifests.merge_batch(raw_rows(spark, sf_dir), lookup_history(spark, sf_dir)).select(
        "video_id", "region_code", "ingest_date", "category_id", "category_name"
    )


query("lookup_versions")(lambda spark, sf_dir: lookup_history(spark, sf_dir).drop("assignable"))


@query("lookup_unmatched")
def _(spark, sf_dir):
    flat = clean.flatten_nested(raw_rows(spark, sf_dir), "region")
    return lookups.lookup_unmatched(flat, lookup_rows(spark, sf_dir), "category_id")


def priority_history(spark, sf_dir):
    """Order priority of a customer as a versioned attribute."""
    orders = tb.table(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    return scd.scd2_from_history(
        orders, ["o_custkey"], ["o_orderpriority"], "day", prefer=F.col("o_orderkey")
    )


@query("validity_join")
def _(spark, sf_dir):
    orders = tb.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    shipped = (
        tb.table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select("l_orderkey", "l_linenumber", "o_custkey", F.to_date("l_shipdate").alias("ship_date"))
    )
    versions = priority_history(spark, sf_dir).withColumn("since", F.col("valid_from"))
    return joins.validity_join(
        shipped, versions, ["o_custkey"], "ship_date", ["since", "o_orderpriority"]
    )


@query("dim_key_resolve")
def _(spark, sf_dir):
    dim = tb.warehouse(spark, sf_dir).table("dim_category")
    keyed = lookups.dim_key_resolve(
        tb.chart(spark, sf_dir).drop("category_name"), dim, "category_id", "category_key"
    )
    # keys themselves are arbitrary: show what they lead to
    return (
        keyed.groupBy("category_key")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .join(dim, "category_key")
        .select("category_id", "category_name", "row_count")
    )


on_chart("self_pair_join", lambda c: joins.pair_counts(c, tb.REGIONS, ["ingest_date"]))


@query("semi_in_subquery")
def _(spark, sf_dir):
    rows = tb.chart(spark, sf_dir)
    return joins.seen_today(video_versions(rows), day_of(rows, tb.DAY), "video_id")


@query("anti_not_exists")
def _(spark, sf_dir):
    rows = tb.chart(spark, sf_dir)
    known = video_versions(until(rows, tb.DAY, strictly=True))
    batch = day_of(rows, tb.DAY).select("video_id", "video_title").distinct()
    return joins.without_current(batch, known, ["video_id"])


on_chart("left_join_previous_day", lambda c: joins.join_previous_day(c, "video_id", "ingest_date"))
on_chart(
    "join_top_groups",
    lambda c: joins.keep_top_groups(c, "category_name", 5).select(
        "video_id", "region_code", "ingest_date", "category_name"
    ),
)
on_chart(
    "lateral_unnest",
    lambda c: joins.explode_tags(c.select("video_id", "region_code", "ingest_date", "video_tags")),
)


def latest_channels(rows):
    return rows.groupBy("channel_id").agg(
        F.max_by("channel_title", "ingest_date").alias("channel_title")
    )


@query("update_from_join")
def _(spark, sf_dir):
    rows = tb.chart(spark, sf_dir)
    return scd.update_from_join(
        latest_channels(until(rows, tb.DAY)), latest_channels(rows), ["channel_id"], ["channel_title"]
    )


# -- warehouse ------------------------------------------------------------


@query("calendar_dim")
def _(spark, sf_dir):
    span = tb.table(spark, sf_dir, "orders").agg(
        F.to_date(F.min("o_orderdate")).alias("first"), F.to_date(F.max("o_orderdate")).alias("last")
    )
    return calendar.calendar_rows(span, "first", "last")


@query("seed_insert_absent")
def _(spark, sf_dir):
    rows = tb.chart(spark, sf_dir)
    name = lambda d, label: d.select("channel_id").distinct().withColumn("origin", F.lit(label))
    return calendar.insert_absent(
        name(day_of(rows, tb.DAY), "seeded"), name(rows, "added"), ["channel_id"]
    )


@query("insert_absent_tags")
def _(spark, sf_dir):
    tag = F.explode("video_tags").alias("tag_name")
    rows = tb.chart(spark, sf_dir)
    # titles extend by a tag here, so that later days bring new ones
    marked = rows.withColumn(
        "video_tags", F.concat("video_tags", F.array(F.concat(F.lit("day "), "ingest_date")))
    )
    known = keys.number_rows(
        until(marked, tb.DAY).select(tag).distinct(), ["tag_name"], "tag_key"
    ).select("tag_key", "tag_name")
    high = keys.highest_key(known, "tag_key")
    after = calendar.insert_absent_tags(known, marked, high)
    return after.select("tag_name", (F.col("tag_key") <= high).alias("was_known"))


@query("lookup_union_last")
def _(spark, sf_dir):
    entries = tb.table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("id"), F.col("p_name").alias("title"), "p_partkey"
    )
    return lookups.lookup_union_last(entries, "id", ["p_partkey"]).select("id", "title")


@query("scd1_upsert")
def _(spark, sf_dir):
    rows = tb.chart(spark, sf_dir)
    early = keys.number_rows(latest_channels(day_of(rows, tb.DAY)), ["channel_id"], "channel_key")
    high = keys.highest_key(early, "channel_key")
    after = scd.scd1_upsert(
        early, latest_channels(rows), ["channel_id"], ["channel_title"], "channel_key", high
    )
    return after.select(
        "channel_id", "channel_title", (F.col("channel_key") <= high).alias("kept_key")
    )


def video_versions(rows):
    return scd.scd2_from_history(rows, ["video_id"], ["video_title"], "ingest_date")


def before_retitle(rows):
    return video_versions(until(rows, RETITLE_DAY, strictly=True))


_VIDEO = (["video_id"], ["video_title"])

on_chart(
    "scd2_close",
    lambda c: scd.scd2_close(before_retitle(c), day_of(c, RETITLE_DAY), *_VIDEO, RETITLE_DAY),
)
on_chart(
    "scd2_open",
    lambda c: scd.scd2_open(
        scd.scd2_close(before_retitle(c), day_of(c, RETITLE_DAY), *_VIDEO, RETITLE_DAY),
        day_of(c, RETITLE_DAY),
        *_VIDEO,
        RETITLE_DAY,
    ),
)


@query("scd2_apply_batch")
def _(spark, sf_dir):
    rows = tb.chart(spark, sf_dir)
    dim = keys.number_rows(before_retitle(rows), ["video_id", "valid_from"], "video_key")
    after = scd.scd2_apply_batch(
        dim, day_of(rows, RETITLE_DAY), *_VIDEO, RETITLE_DAY, "video_key"
    )
    return after.drop("video_key")


on_chart("scd2_from_history", video_versions)


@query("scd2_repair")
def _(spark, sf_dir):
    # DAY arrives after all others; then the day of new titles comes again, with other ones
    rows = tb.chart(spark, sf_dir)
    day = F.lit(tb.DAY).cast("date")
    without = rows.filter(F.col("ingest_date") != day)
    dim = keys.number_rows(video_versions(without), ["video_id", "valid_from"], "video_key")
    late = scd.scd2_repair(dim, without, day_of(rows, tb.DAY), *_VIDEO, tb.DAY, "video_key")
    again = day_of(rows, RETITLE_DAY).filter("CAST(video_id AS BIGINT) % 4 <> 0")
    corrected = again.withColumn("video_title", F.regexp_replace("video_title", " v2$", ""))
    after = scd.scd2_repair(late, rows, corrected, *_VIDEO, RETITLE_DAY, "video_key")
    return after.drop("video_key")


query("scd2_customer_priority")(priority_history)


@query("surrogate_keys")
def _(spark, sf_dir):
    customers = tb.table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority").distinct()
    natural = ["o_custkey", "o_orderpriority"]
    urgent = customers.filter("o_orderpriority IN ('1-URGENT', '2-HIGH')")
    known = keys.number_rows(urgent, natural, "k")
    keyed = keys.assign_keys(customers, known, natural, "k")
    return keyed.join(known.withColumnRenamed("k", "old"), natural, "left").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("k").alias("different_keys"),
        F.min("k").alias("lowest"),
        F.max("k").alias("highest"),
        F.sum(F.when(F.col("k") == F.col("old"), 1).otherwise(0)).alias("kept"),
    )


@query("bridge_refresh")
def _(spark, sf_dir):
    # on the day of new titles each video also loses its first tag and gets its region as one
    rows = tb.chart(spark, sf_dir)
    early = until(rows, RETITLE_DAY, strictly=True)
    size = F.greatest(F.size("video_tags") - 1, F.lit(0))
    retagged = day_of(rows, RETITLE_DAY).withColumn(
        "video_tags", F.array_append(F.slice("video_tags", 2, size), F.col("region_code"))
    )
    tag = F.explode("video_tags").alias("tag_name")
    names = early.select(tag).unionByName(retagged.select(tag)).distinct()
    tags = materialize(keys.number_rows(names, ["tag_name"], "tag_key"), "tags")
    numbered = keys.number_rows(before_retitle(rows), ["video_id", "valid_from"], "video_key")
    dim = materialize(numbered, "videos")
    none = spark.createDataFrame([], "video_key bigint, tag_key bigint")
    links = bridge.bridge_refresh(none, early, dim, tags)
    moved = scd.scd2_apply_batch(dim, retagged, *_VIDEO, RETITLE_DAY, "video_key")
    return (
        bridge.bridge_refresh(links, retagged, moved, tags)
        .join(moved, "video_key")
        .join(tags, "tag_key")
        .select("video_id", "video_title", "tag_name")
    )


@query("bridge_rows")
def _(spark, sf_dir):
    house = tb.warehouse(spark, sf_dir)
    return (
        house.table("bridge")
        .join(house.table("dim_video"), "video_key")
        .join(house.table("dim_tag"), "tag_key")
        .select("video_id", "video_title", "tag_name")
    )


def fact_with_names(house):
    """The fact with what its keys lead to, since the keys are arbitrary."""
    video = house.table("dim_video").select("video_key", "video_title")
    channel = house.table("dim_channel").select("channel_key", "channel_title")
    return (
        house.fact()
        .join(video, "video_key")
        .join(channel, "channel_key")
        .join(house.table("dim_category"), "category_key")
        .join(house.table("dim_region").select("region_key", "region_name"), "region_key")
        .select(
            "video_id",
            "region_code",
            "ingest_date",
            "date_key",
            "video_title",
            "channel_title",
            "category_name",
            "region_name",
            "view_count",
            "like_count",
            "comment_count",
            "regional_rank",
            iso_text("pulled_at").alias("pulled_at"),
        )
    )


query("fact_load")(lambda spark, sf_dir: fact_with_names(tb.warehouse(spark, sf_dir)))


@query("idempotent_claim")
def _(spark, sf_dir):
    rows = tb.chart(spark, sf_dir)
    return unprocessed_batches(rows, until(rows, tb.DAY).select("ingest_date").distinct())


@query("run_day")
def _(spark, sf_dir):
    rows = tb.chart(spark, sf_dir)
    last = str(rows.agg(F.max("ingest_date")).first()[0])
    house = Warehouse(spark, scratch_path(spark, "rerun"), tb.region_seeds(), tb.CALENDAR)
    house.backfill(until(rows, last, strictly=True))
    house.run_day(rows, last)
    # claimed: nothing happens; reprocessed: nothing changes
    house.run_day(rows, last)
    house.run_day(rows, last, reprocess=True)
    return fact_with_names(house)


@query("backfill")
def _(spark, sf_dir):
    house = tb.warehouse(spark, sf_dir)
    return house.table("dim_video").select(
        "video_id",
        "video_title",
        iso_text("published_at").alias("published_at"),
        "valid_from",
        "valid_to",
        "is_current",
    )


# -- aggregations ---------------------------------------------------------

on_chart("overview", lambda c: overview.overview(c, tb.ONE_DAY))
on_chart("overview_delta", lambda c: overview.overview_delta(c, tb.ALL_DAYS))
on_chart("overview_delta_day", lambda c: overview.overview_delta(c, tb.ONE_DAY))
on_chart("spread", lambda c: overview.spread(c, tb.ONE_DAY))
on_chart("category_mix", lambda c: mix.category_mix(c, tb.ONE_DAY))
on_chart("category_order", lambda c: mix.category_order(mix.category_mix(c, tb.ONE_DAY)))
on_chart("chart_size", lambda c: overview.chart_size(c, tb.ONE_DAY))
on_chart("region_overlap", lambda c: overlap.region_overlap(c, tb.ONE_DAY))
on_chart("exclusive_shared", lambda c: overlap.exclusive_shared(c, tb.ONE_DAY))
on_chart("exclusive_shared_all", lambda c: overlap.exclusive_shared(c, tb.ALL_DAYS))
on_chart("hours_to_trend", lambda c: mix.hours_to_trend(c, tb.ONE_DAY, 5, 1))
on_chart("hours_to_trend_all", lambda c: mix.hours_to_trend(c, tb.ALL_DAYS, 30, 0))
on_chart("publish_hour", lambda c: mix.publish_hour(c, tb.ONE_DAY))
on_chart("top_tags", lambda c: engagement.top_tags(c, tb.ONE_DAY))
on_chart("like_rate", lambda c: engagement.like_rate(c, tb.ONE_DAY, tb.MIN_VIEWS))
on_chart("cross_region", lambda c: overlap.cross_region(c, tb.ONE_DAY))
on_chart("top_ranked", lambda c: engagement.top_ranked(c, tb.ONE_DAY))
on_chart("top_channels", lambda c: engagement.top_channels(c, tb.ONE_DAY))
on_chart("concentration", lambda c: engagement.concentration(c, tb.ONE_DAY))
on_chart("daily_totals", lambda c: history.daily_totals(c, tb.ALL_DAYS))
on_chart("category_share", lambda c: mix.category_share(c, tb.ALL_DAYS, tb.CATEGORY))
on_chart("avg_daily_overlap", lambda c: overlap.avg_daily_overlap(c, tb.ALL_DAYS))
on_chart("staying_power", lambda c: history.staying_power(c, tb.ALL_DAYS))
on_chart("one_day_share", lambda c: history.one_day_share(history.staying_power(c, tb.ALL_DAYS)))
on_chart("persistent_channels", lambda c: engagement.persistent_channels(c, tb.ALL_DAYS))
on_chart("daily_churn", lambda c: history.daily_churn(c, tb.ALL_DAYS))
on_chart("avg_turnover", lambda c: history.avg_turnover(history.daily_churn(c, tb.ALL_DAYS)))

# -- safe use of the measures ---------------------------------------------

on_chart(
    "semi_additive_last",
    lambda c: measures.semi_additive_last(c, F.weekofyear("ingest_date")),
)
on_chart("counter_delta", measures.counter_delta)
on_chart("dedup_region_sum", measures.dedup_region_sum)
on_chart("tag_fanout_safe", measures.tag_fanout_safe)
on_chart("retitle_effect", lambda c: measures.retitle_effect(c, video_versions(c)))

# -- windows, ranking, reshaping ------------------------------------------


def channel_counts(rows):
    return rows.groupBy("channel_title").agg(F.count(F.lit(1)).alias("appearances"))


on_chart(
    "rank_groups_global",
    lambda c: topk.rank_groups(channel_counts(c), F.desc("appearances"), ["channel_title"]),
)
on_chart(
    "share_of_partition",
    lambda c: topk.share_of(
        c.groupBy("region_code", "category_name").agg(F.count(F.lit(1)).alias("videos")),
        "videos",
        ["region_code"],
    ),
)
on_chart(
    "top_k",
    lambda c: topk.top_k(
        c.select("video_id", "region_code", "ingest_date", "view_count"),
        [F.desc("view_count")],
        40,
        ["video_id", "region_code", "ingest_date"],
    ),
)
on_chart(
    "top_k_per_group",
    lambda c: topk.top_k_per_group(
        c.select("region_code", "ingest_date", "video_id", "view_count"),
        ["region_code"],
        [F.desc("view_count"), F.asc("video_id"), F.asc("ingest_date")],
        5,
    ),
)
@query("union_regions")
def _(spark, sf_dir):
    raw = files.scan_regions(spark, f"{tb.landing_root(spark, sf_dir)}/raw", tb.REGIONS)
    views = F.col("statistics.viewCount").cast("bigint")
    return raw.groupBy(F.col("region").alias("region_code")).agg(
        F.count(F.lit(1)).alias("row_count"), F.sum(views).alias("total_views")
    )


on_chart("distinct_rows", lambda c: c.select("channel_id", "channel_title").distinct())
on_chart(
    "overlap_matrix",
    lambda c: reshape.overlap_matrix(overlap.region_overlap(c, tb.ONE_DAY), tb.REGIONS),
)
on_chart(
    "avg_overlap_matrix",
    lambda c: reshape.overlap_matrix(
        overlap.avg_daily_overlap(c, tb.ALL_DAYS), tb.REGIONS, "avg_shared"
    ),
)
on_chart("publish_hour_grid", lambda c: reshape.publish_hour_grid(mix.publish_hour(c, tb.ONE_DAY)))
on_chart(
    "exclusive_shared_long",
    lambda c: reshape.exclusive_shared_long(overlap.exclusive_shared(c, tb.ONE_DAY)),
)


@query("region_names")
def _(spark, sf_dir):
    names = tb.warehouse(spark, sf_dir).table("dim_region")
    return lookups.region_names(overview.chart_size(tb.chart(spark, sf_dir)), names)


# -- checks ---------------------------------------------------------------


@query("check_row_reconciliation")
def _(spark, sf_dir):
    return checks.check_row_reconciliation(
        tb.chart(spark, sf_dir), tb.warehouse(spark, sf_dir).fact()
    )


def thinned_out(spark, sf_dir):
    """The chart's rows met with dimensions that lack some of their rows."""
    house = tb.warehouse(spark, sf_dir)
    return fact.resolve_keys(
        tb.chart(spark, sf_dir),
        house.table("dim_video").filter("CAST(video_id AS BIGINT) % 11 <> 0"),
        house.table("dim_channel").filter("channel_title NOT LIKE '%TV'"),
        house.table("dim_category").filter("category_id <> 'PROMO'"),
        house.table("dim_region").filter("region_code <> 'view'"),
        house.table("dim_date").filter("full_date >= DATE'2024-01-05'"),
    )


query("rejected_rows")(lambda spark, sf_dir: fact.rejected_rows(thinned_out(spark, sf_dir)))


@query("check_row_reconciliation_broken")
def _(spark, sf_dir):
    return checks.check_row_reconciliation(
        tb.chart(spark, sf_dir), fact.fact_rows(thinned_out(spark, sf_dir))
    )


@query("check_single_current")
def _(spark, sf_dir):
    return checks.check_single_current(
        tb.warehouse(spark, sf_dir).table("dim_video"), ["video_id"]
    )


# the next ones look at tables that break the rule
on_chart("check_unique", lambda c: checks.check_unique(c, ["video_id", "ingest_date"]))
on_chart("check_not_null", lambda c: checks.check_not_null(c, ["like_count", "comment_count"]))


@query("check_foreign_keys")
def _(spark, sf_dir):
    lookup = lookup_rows(spark, sf_dir)
    return checks.check_foreign_keys(tb.chart(spark, sf_dir), "category_id", lookup, "id")


@query("check_periods")
def _(spark, sf_dir):
    gapped = priority_history(spark, sf_dir).filter("o_orderpriority <> '5-LOW'")
    return checks.check_periods(gapped, ["o_custkey"])


on_chart(
    "check_batch_functional",
    lambda c: checks.check_batch_functional(c, ["channel_id"], ["channel_title"]),
)


@query("check_bridge_complete")
def _(spark, sf_dir):
    house = tb.warehouse(spark, sf_dir)
    rows = tb.chart(spark, sf_dir)
    marked = rows.withColumn("video_tags", F.array_append("video_tags", F.col("region_code")))
    return checks.check_bridge_complete(
        house.table("bridge"), marked, house.table("dim_video"), house.table("dim_tag")
    )


# -- streaming ------------------------------------------------------------


def drain(query) -> None:
    query.awaitTermination()


@query("stream_manifest_batches")
def _(spark, sf_dir):
    root = tb.landing_root(spark, sf_dir)
    out, state = scratch_path(spark, "streamed"), scratch_path(spark, "state")

    def on_batch(arrived: DataFrame, _batch: int) -> None:
        raw = manifests.scan_batches(spark, arrived, root)
        files.replace_partition(manifests.merge_batch(raw, lookup_history(spark, sf_dir)), out)

    drain(stream.stream_manifest_batches(spark, f"{root}/control", on_batch, state))
    return plain(spark.read.parquet(out))


@query("stream_dedup_delivery")
def _(spark, sf_dir):
    root = tb.landing_root(spark, sf_dir)
    out, claims = scratch_path(spark, "merged"), scratch_path(spark, "claims")
    control, state = scratch_path(spark, "control"), scratch_path(spark, "state")
    rows = tb.chart(spark, sf_dir)
    # days up to DAY count as loaded before; every manifest is delivered twice
    until(rows, tb.DAY).select("ingest_date").distinct().write.parquet(claims)
    on_batch = stream.merge_to_chart(
        root,
        out,
        lambda: lookup_history(spark, sf_dir),
        lambda: spark.read.schema("ingest_date date").parquet(claims),
        lambda days: days.write.mode("append").parquet(claims),
    )
    for _delivery in ("first", "second"):
        tb.write_manifests(spark, root, control)
        drain(stream.stream_manifest_batches(spark, control, on_batch, state))
    claimed = spark.read.parquet(claims).groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("claims")
    )
    merged = spark.read.parquet(out).groupBy("ingest_date").agg(
        F.count(F.lit(1)).alias("merged_rows")
    )
    return claimed.join(merged, "ingest_date", "left")


@query("stream_daily_load")
def _(spark, sf_dir):
    root = tb.landing_root(spark, sf_dir)
    house = Warehouse(spark, scratch_path(spark, "live"), tb.region_seeds(), tb.CALENDAR)
    drain(
        stream.stream_daily_load(
            spark,
            f"{root}/control",
            root,
            lambda: lookup_history(spark, sf_dir),
            house,
            scratch_path(spark, "state"),
        )
    )
    return fact_with_names(house)
