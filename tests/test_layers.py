"""Layered tables, and what a day's load writes."""

import os
import random

import pytest
from pyspark.sql import functions as F

from builders import appearance, as_set, chart_of, date
from chartloom.plans.layers import all_rows, merge_from, newest_rows, rows_of_keys
from chartloom.plans.warehouse import KEYS, Warehouse


def layers_of(spark, *layers):
    return [spark.createDataFrame(rows, "k string, n int") for rows in layers]


def test_newest_layer_of_a_key_counts(spark):
    layers = layers_of(spark, [("a", 1), ("b", 1), (None, 1)], [("a", 2), ("c", 2)], [("c", 3), ("d", 3)])
    assert as_set(newest_rows(layers, ["k"])) == {("a", 2), ("b", 1), (None, 1), ("c", 3), ("d", 3)}
    wanted = spark.createDataFrame([("a",), ("c",), ("x",)], "k string")
    assert as_set(rows_of_keys(layers, ["k"], wanted)) == {("a", 2), ("c", 3)}
    assert as_set(rows_of_keys(layers[:1], ["k"], wanted)) == {("a", 1)}
    assert all_rows(layers).count() == 7


def test_merging_keeps_few_layers_and_few_writes():
    rng = random.Random(1)
    for steady in (True, False):
        sizes, written, loaded = [1000], 0, 0
        for _ in range(2000):
            day = 10 if steady else rng.randint(1, 40)
            sizes.append(day)
            loaded += day
            first = merge_from(sizes)
            if first is not None:
                written += sum(sizes[first:])
                sizes = [*sizes[:first], sum(sizes[first:])]
            assert all(a > sum(sizes[i + 1 :]) for i, a in enumerate(sizes[:-1]))
            assert len(sizes) <= 1 + (1000 + loaded).bit_length()
        assert written <= loaded * (1000 + loaded).bit_length()
    assert merge_from([]) is merge_from([5]) is merge_from([5, 3, 1]) is None
    assert merge_from([9, 3, 2, 1]) == 1 and merge_from([6, 3, 2, 1]) == 0


def synthetic(spark, days, videos=120):
    """Half of the videos of a day are those of the day before; some get new titles and tags."""
    v = F.col("v")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("d").cast("int"))
    text = lambda c: c.cast("string")
    rows = (
        spark.range(days)
        .withColumnRenamed("id", "d")
        .select("d", F.explode(F.sequence(F.col("d") * (videos // 2), F.col("d") * (videos // 2) + (videos - 1))).alias("v"))
        .select(day.alias("ingest_date"), "d", "v")
    )
    columns = dict(zip(chart_of(spark, []).columns, appearance()))
    fixed = {n: F.lit(x) for n, x in columns.items() if n not in ("video_tags", "ingest_date")}
    named = {
        "video_id": text(v),
        "video_title": F.concat(text(v), F.when(v % 5 == 0, text(F.col("d"))).otherwise("")),
        "channel_id": text(v % 7),
        "channel_title": F.concat(text(v % 7), F.when(v % 7 == 3, text(F.col("d"))).otherwise("")),
        "video_tags": F.array(F.lit("all"), text(v % 40), F.when(F.col("d") % 3 == 0, "third")),
    }
    chosen = {**fixed, **named}
    return rows.select(*[c.alias(n) for n, c in chosen.items()], "ingest_date").select(*columns)


def written_by(house, version):
    """Bytes of Parquet in the folders of a version."""
    total = 0
    for folder, _, names in os.walk(house.store.root):
        if f"/v={version}-" in folder + "/":
            total += sum(os.path.getsize(os.path.join(folder, n)) for n in names if n.endswith(".parquet"))
    return total


CALENDAR = ("2024-01-01", "2025-12-31")


@pytest.fixture(scope="module")
def grown(spark, tmp_path_factory):
    """Warehouses with 30 and 300 days, and one more day each."""
    found = {}
    for days in (30, 300):
        house = Warehouse(spark, str(tmp_path_factory.mktemp(f"days{days}")), [("AA", "Aland")], CALENDAR)
        rows = synthetic(spark, days + 1).cache()
        newest = str(rows.agg(F.max("ingest_date")).first()[0])
        house.backfill(rows.filter(F.col("ingest_date") < F.lit(newest).cast("date")))
        base = written_by(house, 1)
        house.run_day(rows, newest)
        found[days] = house, base, written_by(house, 2)
        rows.unpersist()
    return found


def test_a_day_costs_a_day(grown):
    (_, base, day), (house, big_base, big_day) = grown[30], grown[300]
    assert big_base > 3 * base
    assert big_day < 1.1 * day
    head = house.store.head()
    for name in ("dim_video_open", "bridge"):
        assert len(head.tables[name]) == 2, name
    # the few channels are all of the day, so they are merged at once
    assert len(head.tables["dim_channel_open"]) == 1
    assert head.rows[head.tables["bridge"][1]] == 120


def state(house):
    period = ["valid_from", "valid_to", "is_current"]
    video = house.table("dim_video")
    return (
        as_set(video, "video_id", "video_title", *period),
        as_set(house.table("dim_channel"), "channel_id", "channel_title", *period),
        as_set(
            house.table("bridge").join(video, "video_key").join(house.table("dim_tag"), "tag_key"),
            "video_id", "video_title", "tag_name",
        ),
        as_set(house.fact().join(video.select("video_key", "video_title"), "video_key"), "video_id", "ingest_date", "video_title"),
        as_set(house.table("dim_category"), "category_id", "category_name"),
    )


def test_folding_days_through_merges_equals_one_pass(spark, tmp_path):
    rows = synthetic(spark, 9, 20).cache()
    whole = Warehouse(spark, str(tmp_path / "whole"), [("AA", "Aland")], CALENDAR)
    whole.backfill(rows)
    folded = Warehouse(spark, str(tmp_path / "folded"), [("AA", "Aland")], CALENDAR)
    merged = 0
    for d in range(1, 10):
        before = folded.store.head().rows
        folded.run_day(rows, f"2024-01-{d:02}")
        head = folded.store.head()
        merged += any(f not in head.rows for f in before)
        # each layer outweighs those over it, and every folder has its rows counted
        for name, folders in head.tables.items():
            sizes = [head.rows[f] for f in folders]
            assert merge_from(sizes) is None, name
            layers = folded._layers(head, name)
            assert [layer.count() for layer in layers] == sizes
            if name in KEYS:
                assert all(layer.select(*KEYS[name]).distinct().count() == n for layer, n in zip(layers, sizes))
    assert merged
    assert state(folded) == state(whole)
    keys = folded.table("dim_video").select("video_key")
    assert keys.count() == keys.distinct().count()


def test_a_null_tag_is_no_tag(spark, tmp_path):
    house = Warehouse(spark, str(tmp_path / "house"), [("AA", "Aland")], CALENDAR)
    house.backfill(chart_of(spark, [appearance("a", video_tags=["x", None]), appearance("b", video_tags=[None])]))
    assert as_set(house.table("dim_tag"), "tag_name") == {("x",)} and house.table("bridge").count() == 1
    # the last tag goes
    house.run_day(chart_of(spark, [appearance("a", day="2024-03-02", video_tags=[])]), "2024-03-02")
    assert house.table("bridge").count() == 0
    assert date("2024-03-02") in {r.ingest_date for r in house.fact().collect()}
