"""Batches announced by manifests, delivered once, twice, late."""

import pytest

from builders import as_set, raw_object, write_lines
from chartloom.plans.warehouse import Warehouse
from chartloom.sources.files import scan_lookup_versions
from chartloom.streaming.manifests import stream_daily_load, stream_manifest_batches


class Landing:
    """A raw zone and the stream that loads it."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, str(root)
        self.house = Warehouse(
            spark, f"{root}/house", [("AA", "Aland")], ("2024-03-01", "2024-03-31")
        )
        self.late = []
        write_lines(f"{root}/control/ingest_date=2024-01-01/none.txt", [])
        self.fetch("2024-01-31", "Music")

    def fetch(self, day, title):
        write_lines(
            f"{self.root}/lookup/fetched_date={day}/x.ndjson", [{"id": "10", "title": title, "assignable": True}]
        )

    def lookups(self):
        return scan_lookup_versions(self.spark, f"{self.root}/lookup")

    def deliver(self, day, run="one", **changes):
        key = f"raw/region=AA/ingest_date={day}/{run}.ndjson"
        write_lines(f"{self.root}/{key}", [raw_object("a", pulled_at=f"{day}T18:00:00Z", **changes)])
        write_lines(
            f"{self.root}/control/ingest_date={day}/{run}.json", [{"date": day, "regions": [key]}]
        )

    def run(self, on_late=None):
        stream_daily_load(
            self.spark, f"{self.root}/control", self.root, self.lookups, self.house,
            f"{self.root}/state", on_late,
        ).awaitTermination()

    def loaded(self):
        return {str(d) for (d,) in as_set(self.house.fact(), "ingest_date")}


@pytest.fixture
def landing(spark, tmp_path):
    return Landing(spark, tmp_path)


def test_days_load_once_and_in_order(landing):
    landing.deliver("2024-03-02")
    landing.deliver("2024-03-01")
    landing.run()
    assert landing.loaded() == {"2024-03-01", "2024-03-02"}
    version = landing.house.store.head().version
    # nothing new; then a second notification for a loaded day
    landing.run()
    landing.deliver("2024-03-02", "again")
    landing.run()
    assert landing.house.store.head().version == version
    landing.deliver("2024-03-03")
    landing.run()
    assert len(landing.loaded()) == 3 and landing.house.fact().count() == 3


def test_late_day_is_handed_over_or_stops_the_stream(landing):
    landing.deliver("2024-03-05")
    landing.run()
    landing.deliver("2024-03-04")
    seen = []
    landing.run(lambda late: seen.extend(r.date for r in late.collect()))
    assert seen == ["2024-03-04"] and landing.loaded() == {"2024-03-05"}
    landing.deliver("2024-03-03")
    with pytest.raises(Exception, match="rebuild"):
        landing.run()


def test_failed_load_is_tried_again(landing):
    bad = {"viewCount": "many"}
    landing.deliver("2024-03-01", statistics=bad)
    with pytest.raises(Exception):
        landing.run()
    assert landing.house.store.head().ledger == []
    # the file is repaired in place and the same notification is replayed
    write_lines(
        f"{landing.root}/raw/region=AA/ingest_date=2024-03-01/one.ndjson", [raw_object("a")]
    )
    landing.run()
    assert landing.loaded() == {"2024-03-01"}


def test_each_day_is_named_by_the_lookup_of_its_date(spark, landing):
    landing.fetch("2024-03-02", "Musik")
    landing.deliver("2024-03-01")
    landing.run()
    named = landing.house.table("dim_category")
    assert as_set(named, "category_name") == {("Music",)}
    # fetched while the stream was down, and for a day that arrives later
    landing.fetch("2024-03-03", "Musique")
    landing.deliver("2024-03-02")
    landing.run()
    assert as_set(landing.house.table("dim_category"), "category_name") == {("Musik",)}
    landing.deliver("2024-03-04")
    landing.run()
    assert as_set(landing.house.table("dim_category"), "category_name") == {("Musique",)}


def test_day_before_the_first_lookup_stops_the_stream(landing):
    landing.house.calendar = ("2024-01-01", "2024-03-31")
    landing.deliver("2024-01-30")
    with pytest.raises(Exception, match="no lookup for category_id before 2024-01-31"):
        landing.run()
    assert landing.house.store.head().ledger == []


def test_each_manifest_fires_once(spark, landing, tmp_path):
    landing.deliver("2024-03-01")
    got = []

    def run():
        stream_manifest_batches(
            spark, f"{tmp_path}/control",
            lambda arrived, _: got.extend(r.date for r in arrived.collect()),
            f"{tmp_path}/fired",
        ).awaitTermination()

    run()
    run()
    assert got == ["2024-03-01"]
