"""Raw files, manifests and the flattening of nested objects."""

import json

import pytest
from pyspark.sql import functions as F

from builders import appearance, as_set, chart_of, date, raw_object, write_lines
from chartloom.operators import clean, lookups
from chartloom.schemas import CATEGORY_LOOKUP, FLAT_LINE, RAW_VIDEO
from chartloom.sources import files, manifests


def raw(spark, tmp_path, objects):
    path = write_lines(str(tmp_path / "raw" / "region=AA" / "ingest_date=2024-03-01" / "x.ndjson"), objects)
    return files.path_columns(
        files.scan_ndjson(spark, path, RAW_VIDEO), {"region": "string", "ingest_date": "date"}
    )


def flat(spark, tmp_path, *objects):
    rows = clean.flatten_nested(raw(spark, tmp_path, objects), "region").collect()
    return rows[0] if len(objects) == 1 else rows


def test_flatten_reads_counters_as_text_or_number(spark, tmp_path):
    quoted, bare = flat(
        spark,
        tmp_path,
        raw_object("a"),
        raw_object("b", statistics={"viewCount": 100, "likeCount": 10, "commentCount": 1}),
    )
    assert (quoted.view_count, quoted.like_count) == (bare.view_count, bare.like_count) == (100, 10)
    assert quoted.region_code == "AA" and str(quoted.ingest_date) == "2024-03-01"


def test_missing_counter_stays_null(spark, tmp_path):
    row = flat(spark, tmp_path, raw_object(statistics={"viewCount": "5"}))
    assert (row.view_count, row.like_count, row.comment_count) == (5, None, None)


def test_missing_parts_become_null(spark, tmp_path):
    item = raw_object()
    del item["snippet"], item["statistics"]
    row = flat(spark, tmp_path, item)
    assert row.video_title is None and row.view_count is None and row.video_tags == []


@pytest.mark.parametrize("tags", [None, "absent", []])
def test_no_tags_is_an_empty_array(spark, tmp_path, tags):
    snippet = {"title": "t"} if tags == "absent" else {"title": "t", "tags": tags}
    assert flat(spark, tmp_path, raw_object(snippet=snippet)).video_tags == []


def test_malformed_counter_raises(spark, tmp_path):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        flat(spark, tmp_path, raw_object(statistics={"viewCount": "1.0"}))
    lenient = clean.cast_counts(spark.sql("SELECT 'bad' AS n"), ["n"], strict=False)
    assert lenient.first().n is None


def test_malformed_line_raises(spark, tmp_path):
    path = write_lines(str(tmp_path / "bad" / "x.ndjson"), [raw_object(), "{not json"])
    with pytest.raises(Exception, match="MALFORMED_RECORD|FAILED_READ_FILE"):
        files.scan_ndjson(spark, path, RAW_VIDEO).collect()


def test_path_values_are_decoded(spark, tmp_path):
    write_lines(str(tmp_path / "region=a b" / "x.ndjson"), [raw_object()])
    lines = spark.read.schema(RAW_VIDEO).json(str(tmp_path), recursiveFileLookup=True)
    assert as_set(files.path_columns(lines, {"region": "string"}), "region") == {("a b",)}


def test_manifest_reads_exactly_the_named_files(spark, tmp_path):
    keep = "raw/region=AA/ingest_date=2024-03-01/second.ndjson"
    write_lines(str(tmp_path / keep), [raw_object("kept")])
    # left over from a run that failed in another region
    write_lines(
        str(tmp_path / "raw/region=AA/ingest_date=2024-03-01/first.ndjson"), [raw_object("stale")]
    )
    control = write_lines(
        str(tmp_path / "control/ingest_date=2024-03-01/manifest.json"),
        [{"date": "2024-03-01", "regions": [keep]}],
    )
    batch = manifests.scan_manifest_batch(spark, control, str(tmp_path))
    assert as_set(batch, "id", "region") == {("kept", "AA")}


def batch_of(spark, root, manifest):
    control = write_lines(f"{root}/control/ingest_date=2024-03-01/m.json", [manifest])
    return manifests.scan_manifest_batch(spark, control, str(root))


def test_stale_lines_are_never_parsed(spark, tmp_path):
    keep = "raw/region=AA/ingest_date=2024-03-01/run +1%.ndjson"
    write_lines(str(tmp_path / keep), [raw_object("kept"), "", "  "])
    write_lines(str(tmp_path / "raw/region=AA/ingest_date=2024-03-01/run 1.ndjson"), ["{broken"])
    write_lines(str(tmp_path / "raw/region=AA/ingest_date=2024-02-29/run +1%.ndjson"), ["{broken"])
    batch = batch_of(spark, tmp_path, {"date": "2024-03-01", "regions": [keep]})
    assert as_set(batch, "id", "region", "ingest_date") == {("kept", "AA", date("2024-03-01"))}
    # but a named file with a malformed line fails
    write_lines(str(tmp_path / keep), [raw_object("kept"), "{broken"])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        batch_of(spark, tmp_path, {"date": "2024-03-01", "regions": [keep]}).collect()


@pytest.mark.parametrize(
    "key, error",
    [
        ("raw/region=AA/ingest_date=2024-03-01/absent.ndjson", "absent.ndjson, which is not under"),
        ("raw/region=AA/ingest_date=2024-03-02/x.ndjson", "manifest of 2024-03-01 names"),
        ("raw/somewhere/x.ndjson", "manifest of 2024-03-01 names"),
    ],
)
def test_manifests_of_wrong_files_are_refused(spark, tmp_path, key, error):
    for day in ("2024-03-01", "2024-03-02"):
        write_lines(str(tmp_path / f"raw/region=AA/ingest_date={day}/x.ndjson"), [raw_object()])
    with pytest.raises(Exception, match=error):
        batch_of(spark, tmp_path, {"date": "2024-03-01", "regions": [key]})


def test_an_empty_file_is_no_missing_file(spark, tmp_path):
    key = "raw/region=AA/ingest_date=2024-03-01/x.ndjson"
    write_lines(str(tmp_path / key), [""])
    assert batch_of(spark, tmp_path, {"date": "2024-03-01", "regions": [key]}).count() == 0
    write_lines(str(tmp_path / key), [])
    with pytest.raises(FileNotFoundError):
        batch_of(spark, tmp_path, {"date": "2024-03-01", "regions": [key]})


def test_folders_no_manifest_names_are_pruned(spark, tmp_path, monkeypatch):
    days = [f"2024-03-{d:02}" for d in range(1, 21)]
    for day in days:
        write_lines(str(tmp_path / f"raw/region=AA/ingest_date={day}/x.ndjson"), [raw_object(day)])
    manifest = {"date": days[4], "regions": [f"raw/region=AA/ingest_date={days[4]}/x.ndjson"]}
    for most, wanted in ((manifests.BROADCAST_FILES, "BroadcastHashJoin"), (0, "Join")):
        monkeypatch.setattr(manifests, "BROADCAST_FILES", most)
        batch = batch_of(spark, tmp_path, manifest)
        assert as_set(batch, "id") == {(days[4],)}
        text = batch._jdf.queryExecution().executedPlan().toString()
        assert wanted in text and "LeftSemi" in text
        if most:
            assert "dynamicpruning" in text.split("PartitionFilters")[1].split("\n")[0]


def test_completeness_needs_every_region(spark):
    delivered = spark.createDataFrame(
        [("2024-03-01", "AA"), ("2024-03-01", "BB"), ("2024-03-02", "AA"), ("2024-03-02", "ZZ")],
        "ingest_date string, region string",
    )
    assert as_set(manifests.completeness_gate(delivered, ["AA", "BB"])) == {("2024-03-01",)}


def lookup(spark, *entries):
    return spark.createDataFrame([(i, t, True) for i, t in entries], CATEGORY_LOOKUP)


def test_lookup_default_and_unmatched(spark):
    rows = chart_of(
        spark,
        [
            appearance("a", category_id="10"),
            appearance("b", category_id="99"),
            appearance("c", category_id=None),
        ],
    ).drop("category_name")
    # a doubled entry must not double rows
    known = lookup(spark, ("10", "Music"), ("10", "Music"))
    named = lookups.lookup_join(rows, known, "category_id", "title")
    assert as_set(named, "video_id", "category_name") == {
        ("a", "Music"), ("b", "UNKNOWN"), ("c", "UNKNOWN")
    }
    missing = lookups.lookup_unmatched(rows, known, "category_id").collect()
    # a NULL id is reported, first
    assert [tuple(r) for r in missing] == [(None, 1), ("99", 1)]


def test_last_entry_of_an_id_in_order_names_it(spark):
    rows = chart_of(spark, [appearance("a")]).drop("category_name")
    known = spark.createDataFrame([("10", "zz", 1), ("10", "aa", 2)], "id string, title string, place int")
    assert lookups.lookup_join(rows, known, "category_id", "title", order=["place"]).first().category_name == "aa"
    assert lookups.lookup_join(rows, known, "category_id", "title").first().category_name == "zz"


def dated_lookups(spark, tmp_path, fetches):
    for day, entries in fetches.items():
        write_lines(
            f"{tmp_path}/lookup/fetched_date={day}/x.ndjson",
            [{"id": i, "title": t, "assignable": True} for i, t in entries] or [""],
        )
    return files.scan_lookup_versions(spark, f"{tmp_path}/lookup")


def test_lookups_as_of_the_batch(spark, tmp_path):
    versions = dated_lookups(
        spark,
        tmp_path,
        {
            "2024-02-01": [("1", "zz"), ("1", "one"), ("2", "two")],
            "2024-02-10": [("1", "one")],
            "2024-02-20": [("1", "uno"), ("2", "two")],
            "2024-02-25": [],
            "2024-03-01": [("2", "two"), ("1", "uno")],
        },
    )
    d = date
    assert as_set(versions, "id", "title", "valid_from", "valid_to") == {
        ("1", "one", d("2024-02-01"), d("2024-02-20")),
        ("1", "uno", d("2024-02-20"), d("2024-02-25")),
        ("1", "uno", d("2024-03-01"), None),
        ("2", "two", d("2024-02-01"), d("2024-02-10")),
        ("2", "two", d("2024-02-20"), d("2024-02-25")),
        ("2", "two", d("2024-03-01"), None),
    }
    days = ["2024-02-01", "2024-02-09", "2024-02-10", "2024-02-19", "2024-02-20", "2024-02-25", "2024-02-29", "2024-05-01"]
    rows = spark.createDataFrame(
        [(i, d(day)) for day in days for i in ("1", "2", None)], "category_id string, ingest_date date"
    )
    named = lookups.lookup_as_of(rows, versions, "category_id", "ingest_date", "title")
    got = {(r.category_id, str(r.ingest_date)): r.category_name for r in named.collect()}
    one = ["one", "one", "one", "one", "uno", "UNKNOWN", "UNKNOWN", "uno"]
    two = ["two", "two", "UNKNOWN", "UNKNOWN", "two", "UNKNOWN", "UNKNOWN", "two"]
    assert got == {
        **{("1", day): t for day, t in zip(days, one)},
        **{("2", day): t for day, t in zip(days, two)},
        **{(None, day): "UNKNOWN" for day in days},
    }
    assert as_set(lookups.valid_on(versions, "2024-02-12"), "id", "title") == {("1", "one")}


def test_absent_lookups_are_refused(spark, tmp_path):
    versions = dated_lookups(spark, tmp_path, {"2024-02-01": [("10", "Music")]})
    early = chart_of(spark, [appearance(day="2024-01-31")]).drop("category_name")
    with pytest.raises(Exception, match="no lookup for category_id before 2024-02-01; a row is of 2024-01-31"):
        lookups.lookup_as_of(early, versions, "category_id", "ingest_date", "title").collect()
    with pytest.raises(lookups.AbsentLookup):
        lookups.lookup_as_of(early, versions.limit(0), "category_id", "ingest_date", "title")
    with pytest.raises(lookups.AbsentLookup):
        files.scan_category_lookup(spark, f"{tmp_path}/lookup", "2024-01-31")


def test_lookup_union_last_region_wins(spark):
    entries = spark.createDataFrame(
        [("1", "first", 0), ("1", "last", 2), ("1", "middle", 1), ("2", "only", 0)],
        "id string, title string, place int",
    )
    merged = lookups.lookup_union_last(entries, "id", ["place"])
    assert as_set(merged, "id", "title") == {("1", "last"), ("2", "only")}


def test_newest_lookup_not_after_the_day(spark, tmp_path):
    for day, title in (("2024-02-01", "old"), ("2024-02-20", "new"), ("2024-04-01", "future")):
        write_lines(
            str(tmp_path / f"lookup/fetched_date={day}/x.ndjson"),
            [{"id": "10", "title": title, "assignable": True}],
        )
    found = files.scan_category_lookup(spark, str(tmp_path / "lookup"), "2024-03-01")
    assert as_set(found, "id", "title") == {("10", "new")}


def test_ranks_run_over_pages(spark):
    pages = spark.createDataFrame(
        [("AA", 0, ["a", "b"]), ("AA", 1, []), ("AA", 2, ["c"]), ("BB", 0, ["d"])],
        "region string, page int, items array<string>",
    )
    ranked = clean.rank_positions(pages, "items", ["region"], "page")
    assert as_set(ranked, "region", "rank", "item") == {
        ("AA", 1, "a"), ("AA", 2, "b"), ("AA", 3, "c"), ("BB", 1, "d")
    }


def test_ndjson_keeps_nulls_and_reads_back(spark, tmp_path):
    rows = chart_of(spark, [appearance(like_count=None), appearance("v2", day="2024-03-02")])
    root = str(tmp_path / "out")
    files.write_ndjson(rows, root)
    files.write_ndjson(rows.filter("ingest_date = DATE'2024-03-02'"), root)
    landed = files.land_raw(spark, root)
    body = json.loads(landed.filter("ingest_date = DATE'2024-03-01'").first().data)
    assert body["like_count"] is None and "like_count" in body and "ingest_date" not in body
    staged = clean.staging_projection(landed)
    assert as_set(staged, "video_id", "like_count", "ingest_date") == as_set(
        rows, "video_id", "like_count", "ingest_date"
    )
    only = clean.staging_projection(landed, "2024-03-02")
    assert as_set(only, "video_id") == {("v2",)}


def test_replacing_a_date_leaves_the_others(spark, tmp_path):
    root = str(tmp_path / "table")
    files.replace_partition(
        chart_of(spark, [appearance("a"), appearance("b", day="2024-03-02")]), root
    )
    files.replace_partition(chart_of(spark, [appearance("c", day="2024-03-02")]), root)
    assert as_set(files.scan_flat_partitioned(spark, root), "video_id") == {("a",), ("c",)}


def test_flat_line_round_trip_types(spark):
    line = spark.createDataFrame(
        [('{"video_id":"a","view_count":"7","regional_rank":3}',)], "data string"
    ).withColumn("ingest_date", F.lit("2024-03-01").cast("date")).withColumn("source_file", F.lit("f"))
    staged = clean.staging_projection(line)
    types = dict(staged.dtypes)
    assert types["view_count"] == "bigint" and types["regional_rank"] == "int"
    assert staged.first().view_count == 7 and len(FLAT_LINE.fields) == 14
