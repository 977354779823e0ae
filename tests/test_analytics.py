"""Properties of the analytic operators, and small charts with known answers."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from builders import appearance, as_set, chart_of, date
from chartloom.functions import lower_median
from chartloom.operators import (
    engagement,
    history,
    joins,
    measures,
    mix,
    overlap,
    overview,
    reshape,
    scd,
)
from chartloom.operators.scope import Scope, available_dates, scope_filter
from chartloom.plans import testbed as tb

TWO = Scope("2024-03-01", ("AA", "BB"))
BOTH = Scope(None, ("AA", "BB"))


def one(df):
    return df.first().asDict()


@pytest.fixture(scope="module")
def gap(spark):
    """Charts of the 1st, 2nd and 4th: the 3rd was not collected."""
    return chart_of(
        spark,
        [
            appearance("a", day="2024-03-01", view_count=10),
            appearance("b", day="2024-03-01", view_count=20),
            appearance("a", day="2024-03-02", view_count=12),
            appearance("a", day="2024-03-04", view_count=15),
            appearance("b", day="2024-03-04", view_count=None),
            appearance("a", "BB", day="2024-03-04", view_count=15),
        ],
    )


# -- meaning --------------------------------------------------------------


def test_delta_looks_at_the_previous_collected_day(gap):
    days = {str(r.ingest_date): r for r in overview.overview_delta(gap, BOTH).collect()}
    assert days["2024-03-01"].row_count_delta is None
    assert days["2024-03-02"].row_count_delta == -1
    assert days["2024-03-04"].row_count_delta == 2
    # no change shows as none
    assert days["2024-03-04"].channels_delta is None
    single = overview.overview_delta(gap, Scope("2024-03-04", ("AA", "BB")))
    assert single.collect() == [days["2024-03-04"]]


def test_churn_looks_at_the_previous_calendar_day(gap):
    assert as_set(history.daily_churn(gap, BOTH)) == {
        (date("2024-03-02"), 1, 0, 0.0),
        (date("2024-03-04"), 2, 2, 100.0),
    }
    assert one(history.avg_turnover(history.daily_churn(gap, BOTH))) == {"avg_new_pct": 50.0}


def test_null_counters_are_skipped_not_zero(gap):
    last = scope_filter(gap, Scope("2024-03-04"))
    assert one(overview.overview(last))["total_views"] == 30
    assert as_set(measures.dedup_region_sum(gap), "ingest_date", "total") == {
        (date("2024-03-01"), 30), (date("2024-03-02"), 12), (date("2024-03-04"), 15)
    }


def test_totals_count_an_entity_per_region_the_safe_sum_does_not(gap):
    day = Scope("2024-03-04", ("AA", "BB"))
    assert one(overview.overview(gap, day))["total_views"] == 30
    assert measures.dedup_region_sum(scope_filter(gap, day)).first().total == 15


def test_counter_delta_spans_the_gap(gap):
    steps = measures.counter_delta(gap).filter("video_id = 'a'").orderBy("ingest_date").collect()
    assert [(str(r.previous_date), r.delta) for r in steps] == [
        ("None", None), ("2024-03-01", 2), ("2024-03-02", 3)
    ]


def test_last_value_in_a_period(gap):
    month = F.date_trunc("month", "ingest_date").cast("date")
    last = measures.semi_additive_last(gap, month)
    # the last observation counts even if its counter is hidden
    assert as_set(last, "video_id", "region_code", "view_count") == {
        ("a", "AA", 15), ("b", "AA", None), ("a", "BB", 15)
    }


def test_staying_power_and_one_day_share(spark, gap):
    staying = history.staying_power(gap, BOTH)
    assert as_set(staying) == {(3, 1), (2, 1)}
    # no video was there for one day only: no row
    assert history.one_day_share(staying).count() == 0
    some = chart_of(spark, [appearance("x"), appearance("y"), appearance("y", day="2024-03-02")])
    assert one(history.one_day_share(history.staying_power(some))) == {"one_day_pct": 50.0}


def test_median_is_an_element(spark):
    rows = chart_of(spark, [appearance(f"v{i}", view_count=v) for i, v in enumerate([1, 2, 3, 10])])
    assert one(overview.chart_size(rows))["median_views"] == 2


def test_hours_are_complete_hours(spark):
    rows = chart_of(
        spark,
        [
            appearance(f"v{i}", published_at="2024-03-01T10:59:00Z", pulled_at="2024-03-01T12:01:00Z")
            for i in range(5)
        ],
    )
    assert mix.hours_to_trend(rows).first().avg_hours == 1.0
    assert mix.hours_to_trend(rows, min_rows=6).count() == 0


def test_publish_hour_has_a_fixed_offset(spark):
    rows = chart_of(spark, [appearance(published_at="2024-03-01T22:30:00Z")])
    assert mix.publish_hour(rows).first().publish_hour == 1
    grid = reshape.publish_hour_grid(mix.publish_hour(rows)).first().asDict()
    assert grid["h01"] == 1 and sum(v for k, v in grid.items() if k.startswith("h")) == 1


def test_category_mix_folds_the_rest(spark):
    sizes = {"A": 7, "B": 6, "C": 5, "D": 4, "E": 3, "F": 2, "G": 1}
    rows = chart_of(
        spark,
        [
            appearance(f"{c}{i}", category_name=c, region="AA")
            for c, n in sizes.items()
            for i in range(n)
        ]
        + [appearance("r", category_name="G", region="BB")],
    )
    mixed = mix.category_mix(rows, TWO)
    assert as_set(mixed, "region_code", "category", "videos") == {
        ("AA", "A", 7), ("AA", "B", 6), ("AA", "C", 5), ("AA", "D", 4), ("AA", "E", 3),
        ("AA", "Other", 3), ("BB", "Other", 1),
    }
    assert [r.category for r in mix.category_order(mixed).collect()] == [*"ABCDE", "Other"]
    shares = mixed.groupBy("region_code").agg(F.sum("pct").alias("s")).collect()
    assert all(abs(r.s - 100) < 0.5 for r in shares)


def test_tags_fold_case_and_skip_empty(spark):
    rows = chart_of(
        spark,
        [
            appearance("a", video_tags=["Red", "blue"]),
            appearance("b", video_tags=["RED"]),
            appearance("c", video_tags=[]),
            appearance("d", video_tags=None),
        ],
    )
    assert [tuple(r) for r in engagement.top_tags(rows).collect()] == [("red", 2), ("blue", 1)]


def test_like_rate_bounds(spark):
    rows = chart_of(
        spark,
        [
            appearance("at", view_count=10_000, like_count=1),
            appearance("above", view_count=10_001, like_count=100),
            appearance("unknown", view_count=20_000, like_count=None),
        ],
    )
    assert as_set(engagement.like_rate(rows), "video_id", "like_rate") == {("above", 1.0)}


def test_safe_tag_totals_count_an_entity_once_per_tag(spark):
    rows = chart_of(
        spark,
        [
            appearance("a", "AA", video_tags=["x", "x", "y"], view_count=5),
            appearance("a", "BB", video_tags=["x"], view_count=5),
            appearance("b", "AA", video_tags=["x"], view_count=1),
            appearance("b", "AA", "2024-03-02", video_tags=[None, "z"], view_count=9),
            appearance("c", "AA", "2024-03-03", video_tags=[], view_count=None),
        ],
    )
    days = measures.tag_fanout_safe(rows)
    later = days.filter("ingest_date > DATE'2024-03-01'")
    assert as_set(later, "tag", "videos", "total") == {("z", 1, 9), (None, 1, 9), (None, 1, None)}
    rows = rows.filter("ingest_date = DATE'2024-03-01'")
    assert as_set(measures.tag_fanout_safe(rows), "tag", "videos", "total") == {("x", 2, 6), ("y", 1, 5), (None, 2, 6)}


def test_retitle_compares_versions(spark):
    title = lambda d: "old" if d < 3 else "new"
    rows = chart_of(
        spark,
        [
            appearance(day=f"2024-03-0{d}", view_count=10 * d, video_title=title(d), regional_rank=9 - d)
            for d in range(1, 5)
        ],
    )
    versions = scd.scd2_from_history(rows, ["video_id"], ["video_title"], "ingest_date")
    effect = measures.retitle_effect(rows, versions).orderBy("version_no").collect()
    assert [(r.video_title, r.days, r.avg_value, r.best_rank, r.avg_change) for r in effect] == [
        ("old", 2, 15.0, 7, None), ("new", 2, 35.0, 5, 20.0)
    ]


def test_validity_is_half_open(spark):
    dim = spark.createDataFrame(
        [("a", 1, date("2024-01-01"), date("2024-01-03")), ("a", 2, date("2024-01-03"), None),
         ("a", 9, date("2024-01-02"), date("2024-01-02"))],
        "id string, k int, valid_from date, valid_to date",
    )
    facts = spark.createDataFrame(
        [("a", date(f"2024-01-0{d}")) for d in (1, 2, 3, 4)] + [("a", date("2023-12-31"))],
        "id string, d date",
    )
    joined = joins.validity_join(facts, dim, ["id"], "d", ["k"])
    assert [r.k for r in joined.orderBy("d").collect()] == [1, 1, 2, 2]


def test_empty_scope_gives_zero_not_an_error(gap):
    nothing = Scope("2030-01-01", ("AA", "BB"))
    assert one(overview.spread(gap, nothing)) == {
        "videos": 0, "shared_videos": 0, "shared_pct": 0.0
    }
    assert overlap.region_overlap(gap, nothing).count() == 0
    matrix = reshape.overlap_matrix(overlap.region_overlap(gap, nothing), ("AA", "BB"))
    assert [tuple(r) for r in matrix.collect()] == [("AA", 0, 0), ("BB", 0, 0)]


def test_dates_newest_first(gap):
    assert [str(r[0])[-2:] for r in available_dates(gap).collect()] == ["04", "02", "01"]


# -- properties on the derived chart --------------------------------------


def test_overlap_against_brute_force(rows, python_rows):
    charts = defaultdict(set)
    for r in python_rows:
        if str(r["ingest_date"]) == tb.DAY:
            charts[r["region_code"]].add(r["video_id"])
    pairs = {
        (r.region_a, r.region_b): r.shared
        for r in overlap.region_overlap(rows, tb.ONE_DAY).collect()
    }
    assert pairs == {
        (a, b): len(charts[a] & charts[b])
        for a in charts
        for b in charts
        if charts[a] & charts[b]
    }
    assert all(pairs[b, a] == n for (a, b), n in pairs.items())
    sizes = {r.region_code: r.videos for r in overview.chart_size(rows, tb.ONE_DAY).collect()}
    assert all(pairs[region, region] == n for region, n in sizes.items())


def test_exclusive_and_shared_add_up(rows):
    for scope in (tb.ONE_DAY, tb.ALL_DAYS):
        split = {
            r.region_code: r.exclusive + r.shared
            for r in overlap.exclusive_shared(rows, scope).collect()
        }
        sizes = {r.region_code: r.videos for r in overview.chart_size(rows, scope).collect()}
        assert split == sizes


def test_staying_power_covers_every_video(rows, python_rows):
    total = history.staying_power(rows).agg(F.sum("videos")).first()[0]
    assert total == len({r["video_id"] for r in python_rows})


def test_ranks_run_from_one_in_every_list(python_rows):
    lists = defaultdict(list)
    for r in python_rows:
        lists[r["region_code"], r["ingest_date"]].append(r["regional_rank"])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in lists.values())


def test_churn_against_brute_force(rows, python_rows):
    days = defaultdict(set)
    for r in python_rows:
        days[r["ingest_date"]].add(r["video_id"])
    first = min(days)
    expected = {
        (d, len(v), len(v - days.get(d.fromordinal(d.toordinal() - 1), set())))
        for d, v in days.items()
        if d > first
    }
    assert as_set(history.daily_churn(rows), "ingest_date", "videos", "new_videos") == expected


def test_concentration_against_brute_force(rows, python_rows):
    held = Counter(r["channel_title"] for r in python_rows)
    found = one(engagement.concentration(rows))
    assert found["all_rows"] == sum(held.values())
    assert found["top10_rows"] == sum(n for _, n in held.most_common(10))


@pytest.mark.parametrize("n", [1, 2, 90_000, 1_000_000, 5_000_000])
def test_the_median_is_an_exact_element_at_any_size(spark, n):
    # a permutation of 0 .. n - 1 in group a, ties and NULLs in group NULL
    rows = spark.range(n).select(
        F.lit("a").alias("g"), ((F.col("id") * 7_368_787 + 5) % n).alias("x")
    )
    ties = spark.range(5).select(F.lit(None).cast("string").alias("g"), F.expr("if(id < 2, null, 4)").alias("x"))
    got = {r.g: r.m for r in lower_median(rows.unionByName(ties), ["g"], "x", "m").collect()}
    assert got == {"a": (n - 1) // 2, None: 4}
    assert lower_median(rows, [], "x", "m").first().m == (n - 1) // 2


def test_the_median_of_all_kinds_of_integers(spark):
    rng = random.Random(4)
    edges = [-(2**63), 2**63 - 1, 0, -1, 1, 2**40, -(2**40), 2**20 - 1, 2**20]
    groups = [[rng.choice(edges) for _ in range(rng.randint(1, 9))] for _ in range(40)]
    groups += [[rng.randint(-(2**k), 2**k) for _ in range(rng.randint(1, 30))] for k in range(1, 62, 3)]
    rows = spark.createDataFrame([(g, x) for g, xs in enumerate(groups) for x in xs], "g int, x long")
    got = {r.g: r.m for r in lower_median(rows, ["g"], "x", "m").collect()}
    assert got == {g: sorted(xs)[(len(xs) - 1) // 2] for g, xs in enumerate(groups)}
    small = spark.createDataFrame([(1, 3), (1, 1), (1, 2)], "g int, x int")
    assert lower_median(small, ["g"], "x", "m").dtypes == [("g", "int"), ("m", "int")]
    assert lower_median(small.limit(0), ["g"], "x", "m").count() == 0
    with pytest.raises(TypeError):
        lower_median(rows.withColumn("x", F.col("x").cast("double")), ["g"], "x", "m")


def test_figures_take_two_reads(rows):
    for df in (overview.overview(rows), overview.chart_size(rows)):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        final = plan.split("== Initial Plan ==")[0]
        assert final.count("FileScan") <= 2, final


def test_change_counts_from_zero_after_a_day_without_the_region(spark):
    rows = chart_of(
        spark,
        [appearance(f"a{i}", "AA", "2024-03-01") for i in range(3)]
        + [appearance("b", "BB", "2024-03-02")]
        + [appearance(f"c{i}", "AA", "2024-03-03") for i in range(5)],
    )
    every = overview.overview_delta(rows, Scope(regions=("AA",)))
    assert [(str(r.ingest_date), r.row_count, r.row_count_delta) for r in every.orderBy("ingest_date").collect()] == [
        ("2024-03-01", 3, None),
        ("2024-03-02", 0, -3),
        ("2024-03-03", 5, 5),
    ]
    one = overview.overview_delta(rows, Scope("2024-03-03", ("AA",))).collect()
    assert [(r.row_count, r.row_count_delta) for r in one] == [(5, 5)]


def test_many_regions_do_not_widen_the_plan(spark):
    names = tuple(f"R{i:03}" for i in range(300))
    # each entity charts in one to three regions, some of them twice
    entities = spark.range(100_000).select(F.col("id").cast("string").alias("video_id"), "id")
    region = lambda k: F.concat(F.lit("R"), F.lpad(((F.col("id") * k + k) % 300).cast("string"), 3, "0"))
    chosen = F.array(*[region(k) for k in (1, 7, 7, 31)])
    columns = dict(zip(chart_of(spark, []).columns, appearance()))
    fixed = {n: F.lit(x) for n, x in columns.items() if n not in ("video_id", "region_code", "video_tags")}
    rows = entities.select(
        "video_id", F.explode(chosen).alias("region_code"), F.array(F.lit("t")).alias("video_tags"),
        *[c.alias(n) for n, c in fixed.items()],
    ).select(*columns)
    every = Scope(regions=names)
    want = Counter()
    for i in range(100_000):
        held = Counter(f"R{(i * k + k) % 300:03}" for k in (1, 7, 7, 31))
        for a, n in held.items():
            for b, m in held.items():
                want[a, b] += n * m
    got = overlap.region_overlap(rows, every)
    assert {(r.region_a, r.region_b): r.shared for r in got.collect()} == want
    width = lambda df: len(df._jdf.queryExecution().optimizedPlan().toString().split("Aggregate")[1])
    for build in (overlap.region_overlap, overlap.exclusive_shared, overview.spread, overlap.cross_region):
        few, many = build(rows, Scope(regions=names[:5])), build(rows, every)
        assert width(many) == width(few)
    several = sum(len({(i * k + k) % 300 for k in (1, 7, 31)}) > 1 for i in range(100_000))
    assert one(overview.spread(rows, every))["shared_videos"] == several
