"""Numbering over many partitions, with one list holding most rows."""

from collections import defaultdict

from pyspark.sql import functions as F

from chartloom.operators.positions import list_positions, running_offsets
from chartloom.operators.topk import rank_groups, top_k_per_group


def skewed(spark):
    # one list has two thirds of the rows, one has no name
    return spark.range(6000).select(
        F.when(F.col("id") % 3 < 2, "hot")
        .when(F.col("id") % 3000 == 2, None)
        .otherwise(F.concat(F.lit("l"), (F.col("id") % 10).cast("string")))
        .alias("list"),
        F.hash("id").cast("bigint").alias("score"),
        "id",
    )


def expected(rows):
    lists = defaultdict(list)
    for r in rows:
        lists[r["list"]].append((-r.score, r.id))
    return {(k, i): n for k, v in lists.items() for n, (_, i) in enumerate(sorted(v), start=1)}


def test_positions_equal_a_sort_per_list(spark):
    rows = skewed(spark)
    got = list_positions(rows, ["list"], [F.desc("score"), F.asc("id")], "place").collect()
    assert {(r["list"], r.id): r.place for r in got} == expected(rows.collect())


def test_positions_of_one_list(spark):
    rows = skewed(spark)
    ranked = rank_groups(rows, F.desc("score"), ["id"]).collect()
    order = sorted(rows.collect(), key=lambda r: (-r.score, r.id))
    assert {r.id: r.rn for r in ranked} == {r.id: n for n, r in enumerate(order, start=1)}
    first = rank_groups(rows, F.desc("score"), ["id"], k=5).collect()
    assert sorted((r.rn, r.id) for r in first) == [(n, order[n - 1].id) for n in range(1, 6)]


def test_top_k_per_group_keeps_the_best(spark):
    rows = skewed(spark)
    kept = top_k_per_group(rows, ["list"], [F.desc("score"), F.asc("id")], 3).collect()
    best = {k for k, n in expected(rows.collect()).items() if n <= 3}
    assert {(r["list"], r.id) for r in kept} == best


def test_offsets_cross_blocks(spark):
    # pages of one list spread over several blocks of the running total
    pages = spark.range(0, 20_000, 7).select(
        F.lit("a").alias("list"), F.col("id").alias("page"), (F.col("id") % 5).alias("n")
    )
    got = {r.page: r.first for r in running_offsets(pages, ["list"], "page", "n", "first").collect()}
    total = 0
    for page in range(0, 20_000, 7):
        assert got[page] == total
        total += page % 5


def test_positions_move_rows_once(spark):
    rows = skewed(spark)
    placed = list_positions(rows, ["list"], [F.desc("score"), F.asc("id")], "place")
    text = placed._jdf.queryExecution().executedPlan().toString()
    # written ranges are in order: numbering them takes neither a window nor an exchange
    assert "Window" not in text and "Exchange hashpartitioning" not in text
