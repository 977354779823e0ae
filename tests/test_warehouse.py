"""The daily load, day after day, on a hand-written chart."""

import shutil
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from builders import appearance, as_set, chart_of, date
from chartloom.operators.checks import QualityError
from chartloom.operators.scd import OutOfOrderBatch
from chartloom.plans.store import Commit, CommitConflict, Store
from chartloom.plans.warehouse import EmptyBatch, Warehouse

REGIONS = [("AA", "Aland"), ("BB", "Bland")]
SPAN = ("2024-03-01", "2024-03-31")
D1, D2, D3 = "2024-03-01", "2024-03-02", "2024-03-03"

FIRST = [
    appearance("a", "AA", D1, video_tags=["x", "y"]),
    appearance("a", "BB", D1, video_tags=["x", "y"]),
    appearance("b", "AA", D1, video_tags=["x"], channel_id="c2", channel_title="two"),
]
# a is retitled and loses a tag, b is absent, c is new
SECOND = [
    appearance("a", "AA", D2, video_title="a again", video_tags=["x"]),
    appearance("c", "BB", D2, video_tags=["z"], channel_title="channel one"),
]


@pytest.fixture
def open_house(spark, tmp_path):
    return lambda name="house": Warehouse(spark, str(tmp_path / name), REGIONS, SPAN)


def links(house):
    return as_set(
        house.table("bridge")
        .join(house.table("dim_video"), "video_key")
        .join(house.table("dim_tag"), "tag_key"),
        "video_id", "video_title", "tag_name",
    )


def facts(house):
    return as_set(
        house.fact().join(house.table("dim_video").select("video_key", "video_title"), "video_key"),
        "video_id", "region_code", "ingest_date", "video_title", "view_count",
    )


def state(house):
    """Everything without the keys, which are arbitrary."""
    period = ["valid_from", "valid_to", "is_current"]
    return (
        facts(house),
        links(house),
        as_set(house.table("dim_video"), "video_id", "video_title", *period),
        as_set(house.table("dim_channel"), "channel_id", "channel_title", *period),
        as_set(house.table("dim_category"), "category_id", "category_name"),
        as_set(house.table("dim_tag"), "tag_name"),
        house.store.head().ledger,
    )


def keyed(house):
    return {(r.video_id, r.valid_from): r.video_key for r in house.table("dim_video").collect()}


@pytest.fixture(scope="module")
def two_days(spark, tmp_path_factory):
    """A warehouse with both days, and its keys and facts after the first."""
    root = str(tmp_path_factory.mktemp("loaded") / "house")
    house, rows = Warehouse(spark, root, REGIONS, SPAN), chart_of(spark, FIRST + SECOND)
    house.run_day(rows, D1)
    first = keyed(house), as_set(house.fact())
    house.run_day(rows, D2)
    return root, *first


@pytest.fixture
def loaded(spark, two_days, tmp_path):
    """A copy of the warehouse with both days."""
    root = shutil.copytree(two_days[0], tmp_path / "loaded")
    return Warehouse(spark, str(root), REGIONS, SPAN)


def test_two_days(loaded):
    assert as_set(loaded.table("dim_video"), "video_id", "video_title", "valid_from", "valid_to") == {
        ("a", "title of a", date(D1), date(D2)),
        ("a", "a again", date(D2), None),
        ("b", "title of b", date(D1), None),
        ("c", "title of c", date(D2), None),
    }
    # the removed tag is gone, the absent video keeps its link, the new tag is there
    assert links(loaded) == {("a", "a again", "x"), ("b", "title of b", "x"), ("c", "title of c", "z")}
    assert ("a", "AA", date(D1), "title of a", 100) in facts(loaded)
    assert ("a", "AA", date(D2), "a again", 100) in facts(loaded)
    fact = loaded.fact()
    assert fact.select("fact_key").distinct().count() == fact.count() == 5
    assert as_set(fact, "date_key") == {(20240301,), (20240302,)}


def test_one_pass_over_the_backlog_equals_the_days(spark, open_house, loaded):
    whole = open_house("whole")
    whole.backfill(chart_of(spark, FIRST + SECOND))
    assert state(whole) == state(loaded)


def test_claimed_day_is_skipped_and_a_rerun_changes_nothing(spark, loaded):
    before, rows = state(loaded), chart_of(spark, FIRST + SECOND)
    assert loaded.run_day(rows, D2) is None and loaded.backfill(rows) is None
    assert loaded.run_day(rows, D2, reprocess=True) is not None
    assert state(loaded) == before


def test_rerun_with_a_corrected_title(spark, loaded):
    fixed = [appearance("a", "AA", D2, video_title="a fixed", video_tags=["x", "w"]), SECOND[1]]
    loaded.run_day(chart_of(spark, fixed), D2, reprocess=True)
    assert as_set(loaded.table("dim_video").filter("video_id = 'a'"), "video_title", "valid_from", "valid_to") == {
        ("title of a", date(D1), date(D2)), ("a fixed", date(D2), None)
    }
    assert {("a", "a fixed", "x"), ("a", "a fixed", "w")} <= links(loaded)
    assert ("a", "AA", date(D2), "a fixed", 100) in facts(loaded)


def test_keys_survive_later_loads(loaded, two_days):
    _, keys, facts_of_day_one = two_days
    later = keyed(loaded)
    assert all(later[version] == key for version, key in keys.items())
    assert facts_of_day_one <= as_set(loaded.fact())


def test_late_day_is_refused_and_placed_by_a_rebuild(spark, loaded):
    early = [
        appearance("a", "AA", "2024-02-29", video_title="earlier", video_tags=["x"]),
    ]
    house = Warehouse(spark, loaded.store.root, REGIONS, ("2024-02-01", "2024-03-31"))
    rows = chart_of(spark, [*early, *FIRST, *SECOND])
    before = state(house)
    with pytest.raises(OutOfOrderBatch):
        house.run_day(rows, "2024-02-29")
    assert state(house) == before
    house.rebuild(rows)
    assert as_set(house.table("dim_video").filter("video_id = 'a'"), "video_title", "valid_from") == {
        ("earlier", date("2024-02-29")), ("title of a", date(D1)), ("a again", date(D2))
    }
    assert house.fact().count() == 6 and len(house.store.head().ledger) == 3


@pytest.mark.parametrize(
    "name, bad",
    [
        ("one_title_per_video", appearance("a", "BB", D3, video_title="another")),
        ("one_title_per_channel", appearance("d", "BB", D3, channel_title="another")),
        ("one_name_per_category", appearance("d", "BB", D3, category_name="another")),
        ("staging_grain", appearance("a", "AA", D3)),
        ("staging_not_null", appearance("d", "BB", D3, channel_id=None)),
        # an unknown region is dropped by the fact join
        ("row_reconciliation", appearance("d", "ZZ", D3)),
    ],
)
def test_failed_gate_publishes_nothing(spark, loaded, name, bad):
    before = state(loaded)
    rows = chart_of(spark, [appearance("a", "AA", D3), bad])
    with pytest.raises(QualityError, match=name):
        loaded.run_day(rows, D3)
    assert state(loaded) == before


def test_rejected_rows_are_listed(spark, loaded):
    rows = chart_of(spark, [appearance("a", "AA", D3), appearance("d", "ZZ", D3), appearance("e", "YY", D3)])
    with pytest.raises(QualityError, match="2 rows have no region; see ") as error:
        loaded.run_day(rows, D3)
    listed = spark.read.parquet(str(error.value).split("see ")[1])
    assert as_set(listed) == {("d", "ZZ", date(D3), "region"), ("e", "YY", date(D3), "region")}


def test_many_regions_and_early_days_have_keys(spark, tmp_path):
    regions = [(f"R{i}", f"Region {i}") for i in range(300)]
    house = Warehouse(spark, str(tmp_path / "house"), regions, ("1998-01-01", "1998-12-31"))
    day = "1998-05-04"
    rows = chart_of(spark, [appearance("a", code, day) for code, _ in regions])
    house.run_day(rows, day)
    before = as_set(house.fact(), "region_code", "fact_key")
    assert sorted(k for _, k in before) == list(range(1, 301))
    # a reload keeps the keys and hands out new ones for new rows
    more = rows.unionByName(chart_of(spark, [appearance("b", "R7", day, regional_rank=2)]))
    house.run_day(more, day, reprocess=True)
    after = as_set(house.fact(), "region_code", "fact_key")
    assert before < after and after - before == {("R7", 301)}


def test_day_outside_the_calendar_is_caught(spark, loaded):
    with pytest.raises(QualityError, match="row_reconciliation"):
        loaded.run_day(chart_of(spark, [appearance("a", "AA", "2024-04-01")]), "2024-04-01")


def test_two_writers_cannot_publish_the_same_version(spark, tmp_path, loaded):
    taken = loaded.store.head()
    with pytest.raises(CommitConflict):
        Store(spark, loaded.store.root).publish(taken)


def test_a_folder_without_a_record_is_no_commit(loaded, tmp_path):
    before = loaded.store.head()
    (tmp_path / "loaded" / "commits" / "n=3" / "_temporary").mkdir(parents=True)
    assert loaded.store.head() == before
    loaded.store.publish(replace(before, version=3))
    assert loaded.store.head().version == 3


def test_simultaneous_publishes_leave_one_record(spark, tmp_path):
    for turn in range(20):
        store = Store(spark, str(tmp_path / f"race{turn}"))
        with ThreadPoolExecutor(2) as pool:
            runs = [pool.submit(store.publish, Commit(version=1, dates=[d])) for d in ("a", "b")]
        errors = [run.exception() for run in runs]
        assert sorted(type(e) for e in errors if e) == [CommitConflict]
        won = next(d for d, e in zip(("a", "b"), errors) if not e)
        assert store.head().dates == [won]


def test_a_losing_load_leaves_the_winner_alone(spark, tmp_path, loaded):
    head = loaded.store.head()
    day = chart_of(spark, [appearance("w", "AA", "2024-03-04")])
    other = chart_of(spark, [appearance("x", "AA", "2024-03-04"), appearance("y", "BB", "2024-03-04")])
    loaded._load(head, day, ["2024-03-04"])
    names = ["dim_video", "dim_channel", "dim_category", "dim_tag", "bridge"]
    before = [sorted(loaded.table(n).collect(), key=str) for n in names]
    fact = sorted(loaded.fact().collect(), key=str)
    with pytest.raises(CommitConflict):
        loaded._load(head, other, ["2024-03-04"])
    assert [sorted(loaded.table(n).collect(), key=str) for n in names] == before
    assert sorted(loaded.fact().collect(), key=str) == fact


def test_a_day_without_rows_is_refused(spark, loaded):
    before = loaded.store.head()
    with pytest.raises(EmptyBatch):
        loaded.run_day(chart_of(spark, [appearance("a", "AA", "2024-03-04")]), "2024-03-05")
    with pytest.raises(EmptyBatch):
        loaded.rebuild(chart_of(spark, [appearance("a", "AA", "2024-03-04")]).limit(0))
    assert loaded.store.head() == before and loaded.fact().count() > 0


def test_an_empty_log_is_an_empty_warehouse(spark, tmp_path):
    (tmp_path / "new" / "commits").mkdir(parents=True)
    house = Warehouse(spark, str(tmp_path / "new"), REGIONS, SPAN)
    assert house.store.head().version == 0
    assert house.fact().count() == house.table("dim_video").count() == 0


def test_day_is_free_after_a_failure_and_categories_are_overwritten(spark, loaded):
    rows = chart_of(
        spark, [appearance("a", "AA", D3, category_name="Musik", video_tags=["X", "x"], video_title="a again")]
    )
    with pytest.raises(QualityError):
        loaded.run_day(rows.unionAll(rows), D3)
    loaded.run_day(rows, D3)
    assert loaded.store.head().newest_date() == D3
    assert as_set(loaded.table("dim_category"), "category_id", "category_name") == {("10", "Musik")}
    # tags keep their spelling
    assert {("X",), ("x",)} <= as_set(loaded.table("dim_tag"), "tag_name")


def test_calendar(loaded):
    dim = loaded.table("dim_date")
    assert dim.count() == 31
    row = dim.filter("date_key = 20240303").first()
    # a Sunday
    assert (row.day_of_week, row.day_name, row.month_name, row.quarter) == (0, "Sunday", "March", 1)
    assert loaded.table("dim_date").filter(F.col("day_of_week") > 6).count() == 0
