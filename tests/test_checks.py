"""Each gate passes on clean rows and counts the offenders on broken ones."""

import pytest

from builders import appearance, chart_of, date
from chartloom.operators import checks


def verdict(check):
    row = check.first()
    return row.observed, row.passed


def versions(spark, *rows):
    return spark.createDataFrame(
        [(k, i, f"t{k}", date(a), b and date(b), b is None) for k, i, a, b in rows],
        "video_key bigint, video_id string, video_title string, valid_from date,"
        " valid_to date, is_current boolean",
    )


@pytest.fixture(scope="module")
def clean(spark):
    return chart_of(spark, [appearance("a"), appearance("b"), appearance("a", "BB")])


def test_reconciliation_compares_both_sides(clean):
    fewer = clean.filter("video_id = 'a'")
    assert checks.check_row_reconciliation(clean, clean, "2024-03-01").first().passed
    row = checks.check_row_reconciliation(clean, fewer).first()
    assert (row.observed, row.expected, row.passed) == (2, 3, False)
    assert checks.unreconciled(clean, fewer).first().video_id == "b"
    other_day = checks.check_row_reconciliation(clean, fewer, "2024-03-02").first()
    assert (other_day.observed, other_day.passed) == (0, True)


def test_unique(clean):
    assert verdict(checks.check_unique(clean, ["video_id", "region_code"])) == (0, True)
    assert verdict(checks.check_unique(clean, ["video_id"])) == (1, False)


def test_not_null(spark, clean):
    assert verdict(checks.check_not_null(clean, ["video_id", "channel_id"])) == (0, True)
    broken = chart_of(spark, [appearance(channel_id=None), appearance("b")])
    assert verdict(checks.check_not_null(broken, ["video_id", "channel_id"])) == (1, False)


def test_foreign_keys(spark, clean):
    dim = spark.createDataFrame([("a",)], "id string")
    assert verdict(checks.check_foreign_keys(clean, "video_id", dim, "id")) == (1, False)
    assert verdict(checks.check_foreign_keys(dim, "id", clean, "video_id")) == (0, True)


def test_single_current(spark):
    good = versions(spark, (1, "a", "2024-01-01", "2024-01-05"), (2, "a", "2024-01-05", None))
    bad = versions(spark, (1, "a", "2024-01-01", None), (2, "a", "2024-01-05", None))
    assert verdict(checks.check_single_current(good, ["video_id"])) == (0, True)
    assert verdict(checks.check_single_current(bad, ["video_id"])) == (1, False)


@pytest.mark.parametrize(
    "second, third, broken",
    [
        (("2024-01-05", "2024-01-09"), ("2024-01-09", None), 0),
        # gap, overlap, negative, no length
        (("2024-01-06", "2024-01-09"), ("2024-01-09", None), 1),
        (("2024-01-04", "2024-01-09"), ("2024-01-09", None), 1),
        (("2024-01-05", "2024-01-03"), ("2024-01-09", None), 1),
        (("2024-01-05", "2024-01-05"), ("2024-01-09", None), 1),
    ],
)
def test_periods(spark, second, third, broken):
    dim = versions(spark, (1, "a", "2024-01-01", "2024-01-05"), (2, "a", *second), (3, "a", *third))
    observed, passed = verdict(checks.check_periods(dim, ["video_id"]))
    assert passed == (broken == 0) and (observed > 0) == (broken > 0)


def test_batch_functional(spark, clean):
    assert verdict(checks.check_batch_functional(clean, ["video_id"], ["video_title"])) == (0, True)
    split = chart_of(spark, [appearance(), appearance(region="BB", video_title=None)])
    assert verdict(checks.check_batch_functional(split, ["video_id"], ["video_title"])) == (1, False)


def test_bridge_complete(spark):
    staged = chart_of(spark, [appearance("a")])
    dim = versions(spark, (1, "a", "2024-01-01", None))
    tags = spark.createDataFrame([(1, "red"), (2, "blue")], "tag_key bigint, tag_name string")
    whole = spark.createDataFrame([(1, 1), (1, 2)], "video_key bigint, tag_key bigint")
    assert verdict(checks.check_bridge_complete(whole, staged, dim, tags)) == (0, True)
    part = whole.filter("tag_key = 1")
    assert verdict(checks.check_bridge_complete(part, staged, dim, tags)) == (1, False)


def test_enforce_names_what_failed(clean):
    checks.enforce([checks.check_unique(clean, ["video_id", "region_code"])])
    with pytest.raises(checks.QualityError, match="grain: observed 1, expected 0"):
        checks.enforce(
            [checks.check_unique(clean, ["video_id"], "grain"), checks.check_not_null(clean, ["video_id"])]
        )
