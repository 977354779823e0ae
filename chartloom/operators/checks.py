"""Constraints and quality gates.

Every check is a lazy one-row DataFrame ``(check, observed, expected,
passed)``; ``enforce`` runs a set of them in one job and raises.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartloom.operators.bridge import staged_links


class QualityError(RuntimeError):
    """At least one gate did not pass."""


def _verdict(counts: DataFrame, name: str) -> DataFrame:
    return counts.select(
        F.lit(name).alias("check"),
        F.col("observed").cast("bigint"),
        F.col("expected").cast("bigint"),
        (F.col("observed") == F.col("expected")).alias("passed"),
    )


def _none_expected(offenders: DataFrame, name: str) -> DataFrame:
    found = offenders.agg(F.count(F.lit(1)).alias("observed")).withColumn("expected", F.lit(0))
    return _verdict(found, name)


def unreconciled(staging: DataFrame, fact: DataFrame) -> DataFrame:
    """The staged rows that did not reach the fact."""
    grain = ["video_id", "region_code", "ingest_date"]
    return staging.join(fact.select(*grain), grain, "left_anti")


def check_row_reconciliation(
    staging: DataFrame, fact: DataFrame, day: str | dt.date | None = None,
    name: str = "row_reconciliation",
) -> DataFrame:
    """As many fact rows as staged rows (of one day, or of all given days)."""
    if day is not None:
        on_day = F.col("ingest_date") == F.lit(str(day)).cast("date")
        staging, fact = staging.filter(on_day), fact.filter(on_day)
    sides = fact.select(F.lit(1).alias("f"), F.lit(0).alias("s")).unionAll(
        staging.select(F.lit(0).alias("f"), F.lit(1).alias("s"))
    )
    counts = sides.agg(
        F.coalesce(F.sum("f"), F.lit(0)).alias("observed"),
        F.coalesce(F.sum("s"), F.lit(0)).alias("expected"),
    )
    return _verdict(counts, name)


def check_unique(df: DataFrame, keys: list[str], name: str = "unique") -> DataFrame:
    """No key occurs twice; observed counts the keys that do."""
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return _none_expected(repeated, name)


def check_single_current(
    dim: DataFrame, keys: list[str], name: str = "single_current"
) -> DataFrame:
    """At most one open version per key."""
    return check_unique(dim.filter("is_current"), keys, name)


def check_not_null(df: DataFrame, columns: list[str], name: str = "not_null") -> DataFrame:
    """No NULL in the required columns; one pass over all of them."""
    missing = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns))
    return _none_expected(df.filter(missing), name)


def check_foreign_keys(
    df: DataFrame, fk: str, dim: DataFrame, pk: str, name: str = "foreign_key"
) -> DataFrame:
    """Every key of ``df`` exists in ``dim``; observed counts orphan keys.

    Keys are reduced to distinct values before the join, so a hot key costs
    one row.
    """
    used = df.select(F.col(fk).alias("_fk")).distinct()
    orphans = used.join(dim.select(F.col(pk).alias("_fk")), "_fk", "left_anti")
    return _none_expected(orphans, name)


def check_periods(dim: DataFrame, keys: list[str], name: str = "periods") -> DataFrame:
    """Versions of a key follow each other without gap, overlap or zero length."""
    by_key = Window.partitionBy(*keys).orderBy("valid_from", F.asc_nulls_last("valid_to"))
    broken = dim.withColumn("_next", F.lead("valid_from").over(by_key)).filter(
        ~F.col("valid_to").eqNullSafe(F.col("_next")) | (F.col("valid_to") <= F.col("valid_from"))
    )
    return _none_expected(broken, name)


def check_batch_functional(
    batch: DataFrame,
    keys: list[str],
    attrs: list[str],
    name: str = "batch_functional",
) -> DataFrame:
    """One set of attribute values per key; include the date in ``keys`` for many days."""
    split = batch.select(*keys, *attrs).distinct().groupBy(*keys).count().filter("count > 1")
    return _none_expected(split, name)


def check_bridge_complete(
    bridge: DataFrame,
    staging: DataFrame,
    dim_video: DataFrame,
    dim_tag: DataFrame,
    name: str = "bridge_complete",
) -> DataFrame:
    """Every staged (video, tag) has its link from the open version."""
    linked = (
        bridge.join(dim_video.filter("is_current").select("video_key", "video_id"), "video_key")
        .join(dim_tag.select("tag_key", "tag_name"), "tag_key")
        .select("video_id", "tag_name")
    )
    missing = staged_links(staging).join(linked, ["video_id", "tag_name"], "left_anti")
    return _none_expected(missing, name)


def all_checks(checks: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def enforce(checks: list[DataFrame]) -> None:
    """Run the checks together; raise with the ones that failed."""
    # one row per check
    failed = all_checks(checks).filter(~F.col("passed")).collect()
    if failed:
        raise QualityError(
            "; ".join(f"{r['check']}: observed {r.observed}, expected {r.expected}" for r in failed)
        )
