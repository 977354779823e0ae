"""Type-1 and type-2 dimensions, surrogate keys."""

import random

import pytest
from pyspark.sql import functions as F

from builders import as_set, date
from chartloom.operators import keys, scd

DIM = "k bigint, id string, name string, valid_from date, valid_to date, is_current boolean"
PERIOD = ["id", "name", "valid_from", "valid_to", "is_current"]


def batch(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id string, name string")


def apply(spark, dim, day):
    date_text, pairs = day
    after = scd.scd2_apply_batch(dim, batch(spark, *pairs), ["id"], ["name"], date_text, "k")
    # rows instead of a growing plan
    return spark.createDataFrame(after.collect(), DIM)


def history(spark, days):
    rows = [(i, n, date(day)) for day, pairs in days for i, n in pairs]
    return spark.createDataFrame(rows, "id string, name string, day date")


DAYS = [
    ("2024-01-01", [("a", "A"), ("b", "B"), ("n", None)]),
    ("2024-01-02", [("a", "A2"), ("b", "B"), ("n", None)]),
    ("2024-01-03", [("a", "A"), ("n", "N")]),
    ("2024-01-05", [("a", "A"), ("b", "B2"), ("c", "C"), ("n", None)]),
]


@pytest.fixture(scope="module")
def states(spark):
    """The dimension after each of the days."""
    dim, after = spark.createDataFrame([], DIM), []
    for day in DAYS:
        dim = apply(spark, dim, day)
        after.append(dim)
    return after


def test_daily_fold_equals_one_pass(spark, states):
    one_pass = scd.scd2_from_history(history(spark, DAYS), ["id"], ["name"], "day")
    assert as_set(states[-1], *PERIOD) == as_set(one_pass, *PERIOD)


def test_change_and_change_back_gives_three_versions(states):
    versions = states[-1].filter("id = 'a'").orderBy("valid_from").collect()
    assert [(r["name"], str(r.valid_from), str(r.valid_to)) for r in versions] == [
        ("A", "2024-01-01", "2024-01-02"),
        ("A2", "2024-01-02", "2024-01-03"),
        ("A", "2024-01-03", "None"),
    ]


def test_absent_key_keeps_its_version(states):
    versions = states[2].filter("id = 'b'").collect()
    assert [(r["name"], r.valid_to, r.is_current) for r in versions] == [("B", None, True)]


def test_null_is_a_value(states):
    assert states[-1].filter("id = 'n'").count() == 3


def test_keys_stay_and_never_repeat(states):
    of = lambda dim: {(r.id, r.valid_from): r.k for r in dim.collect()}
    before, after = of(states[1]), of(states[-1])
    assert all(after[v] == k for v, k in before.items())
    assert len(set(after.values())) == len(after)


def test_rerun_of_the_newest_day_changes_nothing(spark, states):
    assert as_set(apply(spark, states[-1], DAYS[-1])) == as_set(states[-1])


def test_correction_on_the_same_day_leaves_no_empty_version(spark):
    dim = spark.createDataFrame([], DIM)
    for title in ("A", "A fixed"):
        dim = apply(spark, dim, ("2024-01-01", [("a", title)]))
    assert as_set(dim, *PERIOD) == {("a", "A fixed", date("2024-01-01"), None, True)}


def test_older_day_is_refused(spark, states):
    with pytest.raises(scd.OutOfOrderBatch):
        apply(spark, states[-1], ("2024-01-04", [("a", "late")]))


def test_close_then_open_equals_apply(spark, states):
    dim = states[0]
    args = (batch(spark, *DAYS[1][1]), ["id"], ["name"], DAYS[1][0])
    steps = scd.scd2_open(scd.scd2_close(dim, *args), *args, key="k", start=keys.highest_key(dim, "k"))
    assert as_set(steps, *PERIOD) == as_set(states[1], *PERIOD)


def test_prefer_settles_two_values_on_one_day(spark):
    rows = spark.createDataFrame(
        [("a", "x", date("2024-01-01"), 2), ("a", "y", date("2024-01-01"), 1)],
        "id string, name string, day date, seq int",
    )
    versions = scd.scd2_from_history(rows, ["id"], ["name"], "day", prefer=F.col("seq"))
    assert as_set(versions, "name") == {("x",)}


def test_upsert_keeps_keys_and_touches_only_changes(spark):
    dim = spark.createDataFrame([(1, "a", "A"), (2, "b", None)], "k bigint, id string, name string")
    incoming = batch(spark, ("a", "A new"), ("b", None), ("c", "C"))
    after = scd.scd1_upsert(dim, incoming, ["id"], ["name"], "k", 2)
    assert as_set(after) == {(1, "a", "A new"), (2, "b", None), (3, "c", "C")}
    touched = scd.update_from_join(dim, incoming, ["id"], ["name"])
    assert as_set(touched, "id", "was_updated") == {("a", True), ("b", False)}


def test_numbers_are_dense_distinct_and_repeatable(spark):
    rows = spark.range(10_000).select((F.col("id") * 7).cast("string").alias("id"))
    first = as_set(keys.number_rows(rows, ["id"], "k", start=5))
    again = as_set(keys.number_rows(rows.repartition(3, F.rand()), ["id"], "k", start=5))
    assert first == again and {k for _, k in first} == set(range(6, 10_006))


def test_assigned_keys_extend_known_ones(spark):
    known = spark.createDataFrame([("a", 7)], "id string, k bigint")
    rows = spark.createDataFrame([("a",), ("b",)], "id string")
    assert as_set(keys.assign_keys(rows, known, ["id"], "k")) == {("a", 7), ("b", 8)}


@pytest.mark.parametrize("seed", [1, 2])
def test_days_in_any_order_with_corrections_equal_the_history(spark, seed):
    rng = random.Random(seed)
    names = [f"2024-01-{d:02}" for d in range(1, 11)]
    draw = lambda: [(i, rng.choice(["A", "B", None])) for i in "abcdef" if rng.random() < 0.6]
    # every day once, in any order, and some of them again with other rows
    deliveries = [*rng.sample(names, 10), *rng.choices(names, k=3)]
    days, dim, keyed = {}, spark.createDataFrame([], DIM), {}
    for day in deliveries:
        known = history(spark, list(days.items())) if any(days.values()) else history(spark, [("2024-01-01", [("x", "X")])]).limit(0)
        days[day] = draw()
        rows = batch(spark, *days[day]) if days[day] else batch(spark, ("x", "X")).limit(0)
        after = scd.scd2_repair(dim, known, rows, ["id"], ["name"], day, "k", date="day").collect()
        dim = spark.createDataFrame(after, DIM)
        want = scd.scd2_from_history(history(spark, list(days.items())), ["id"], ["name"], "day")
        assert {(r.id, r.name, r.valid_from, r.valid_to, r.is_current) for r in after} == as_set(want, *PERIOD)
        # keys are distinct, and what kept its start and name keeps its key
        assert len({r.k for r in after}) == len(after)
        now = {(r.id, r.name, r.valid_from): r.k for r in after}
        assert all(now[v] == k for v, k in keyed.items() if v in now)
        keyed = now


def test_repair_leaves_other_keys_alone(spark):
    days = [("2024-01-01", [("a", "A"), ("b", "B")]), ("2024-01-03", [("a", "C"), ("b", "D")])]
    dim = keys.number_rows(
        scd.scd2_from_history(history(spark, days), ["id"], ["name"], "day"), ["id", "valid_from"], "k"
    )
    before = {tuple(r) for r in dim.filter("id = 'b'").select("k", *PERIOD).collect()}
    after = scd.scd2_repair(dim, history(spark, days), batch(spark, ("a", "B")), ["id"], ["name"], "2024-01-02", "k", date="day")
    assert {tuple(r) for r in after.filter("id = 'b'").select("k", *PERIOD).collect()} == before
    assert as_set(after.filter("id = 'a'"), "name", "valid_from", "valid_to") == {
        ("A", date("2024-01-01"), date("2024-01-02")),
        ("B", date("2024-01-02"), date("2024-01-03")),
        ("C", date("2024-01-03"), None),
    }
