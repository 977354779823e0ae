"""Slowly changing dimensions, types 1 and 2.

A type-2 version covers ``[valid_from, valid_to)``; the open one has
``valid_to`` NULL and ``is_current`` true.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.functions import changed
from chartloom.operators.joins import without_current
from chartloom.operators.keys import highest_key, number_rows
from chartloom.session import materialize


class OutOfOrderBatch(ValueError):
    """A batch older than the newest version; only a rebuild can place it."""


def update_from_join(
    target: DataFrame, source: DataFrame, keys: list[str], attrs: list[str]
) -> DataFrame:
    """``target`` with the attributes overwritten where ``source`` differs.

    Also says which rows that touched, in ``was_updated``.
    """
    incoming = source.select(*keys, F.lit(True).alias("_hit"), *[
        F.col(a).alias(f"_new_{a}") for a in attrs
    ])
    differs = F.coalesce(F.col("_hit"), F.lit(False)) & changed(
        [F.col(a) for a in attrs], [F.col(f"_new_{a}") for a in attrs]
    )
    joined = target.join(incoming, keys, "left").withColumn("was_updated", differs)
    updated = {a: F.when(F.col("was_updated"), F.col(f"_new_{a}")).otherwise(F.col(a)) for a in attrs}
    return joined.withColumns(updated).select(*target.columns, "was_updated")


def scd1_upsert(
    dim: DataFrame, batch: DataFrame, keys: list[str], attrs: list[str], key: str | None = None,
    start: int = 0,
) -> DataFrame:
    """Overwrite changed attributes, insert new keys, keep surrogate keys.

    ``batch`` holds one row per key.  With ``key`` the inserted rows are
    numbered from above ``start``.
    """
    kept = update_from_join(dim, batch, keys, attrs).drop("was_updated")
    fresh = batch.select(*keys, *attrs).join(dim.select(*keys), keys, "left_anti")
    if key is not None:
        fresh = number_rows(fresh, keys, key, start)
    return kept.unionByName(fresh.select(*dim.columns))


def scd1_changes(
    dim: DataFrame, batch: DataFrame, keys: list[str], attrs: list[str], key: str, start: int = 0
) -> DataFrame:
    """The rows of ``scd1_upsert`` that are new or changed, and no others."""
    updated = update_from_join(dim, batch, keys, attrs).filter("was_updated").drop("was_updated")
    fresh = batch.select(*keys, *attrs).join(dim.select(*keys), keys, "left_anti")
    return updated.unionByName(number_rows(fresh, keys, key, start).select(*dim.columns))


def _versions(
    history: DataFrame, keys: list[str], attrs: list[str], date: str, carried: list[str]
) -> DataFrame:
    """Versions out of one observation per key and date.

    ``_open`` marks observations that are the version open so far; they come
    first in their key and bring the ``carried`` columns along.  The window
    holds one row per day a key was observed, whatever the row volume.
    """
    by_key = Window.partitionBy(*keys).orderBy(date, F.desc("_open"))
    state = F.struct(*attrs)
    starts = history.withColumn(
        "_starts",
        F.row_number().over(by_key).eqNullSafe(F.lit(1))
        | ~state.eqNullSafe(F.lag(state).over(by_key)),
    ).filter("_starts")
    return (
        starts.withColumn("valid_to", F.lead(date).over(by_key))
        # a same-day correction leaves a version of no length: drop it
        .filter(F.col("valid_to").isNull() | (F.col("valid_to") > F.col(date)))
        .select(
            *carried,
            *keys,
            *attrs,
            F.col(date).alias("valid_from"),
            "valid_to",
            F.col("valid_to").isNull().alias("is_current"),
        )
    )


def _observations(
    history: DataFrame, keys: list[str], attrs: list[str], date: str, prefer: Column | None
) -> DataFrame:
    """One row per key and date, reduced before the exchange.

    Without ``prefer`` differing attributes of one key on one day stay apart;
    gate them with ``check_batch_functional``.  With it the largest wins.
    """
    if prefer is None:
        return history.select(*keys, date, *attrs).distinct()
    last = F.max_by(F.struct(*attrs), prefer).alias("_last")
    return (
        history.groupBy(*keys, date).agg(last).select(*keys, date, *[f"_last.{a}" for a in attrs])
    )


def scd2_from_history(
    history: DataFrame,
    keys: list[str],
    attrs: list[str],
    date: str,
    prefer: Column | None = None,
) -> DataFrame:
    """All versions of a whole backlog in one pass.

    Equals applying the days one after another.  A key absent for some days
    keeps its version; a value that comes back opens a third version.
    """
    seen = _observations(history, keys, attrs, date, prefer)
    return _versions(seen.withColumn("_open", F.lit(False)), keys, attrs, date, [])


def scd2_advance(
    dim: DataFrame,
    history: DataFrame,
    keys: list[str],
    attrs: list[str],
    date: str,
    key: str,
    prefer: Column | None = None,
) -> DataFrame:
    """Carry the open versions of ``dim`` through one or many later days.

    Returns every version that is open now or was closed in these days; new
    ones have a NULL surrogate ``key``.  Versions closed earlier are not read.
    """
    open_now = dim.filter("is_current").select(
        key, *keys, *attrs, F.col("valid_from").alias(date), F.lit(True).alias("_open")
    )
    seen = _observations(history, keys, attrs, date, prefer).select(
        F.lit(None).cast(dim.schema[key].dataType).alias(key),
        *keys,
        *attrs,
        date,
        F.lit(False).alias("_open"),
    )
    return _versions(open_now.unionByName(seen), keys, attrs, date, [key])


def refuse_older(dim: DataFrame, day: str | dt.date) -> None:
    """Raise if ``dim`` has a version starting after ``day`` (reads one aggregate row)."""
    newest = dim.agg(F.max("valid_from")).first()[0]
    if newest is not None and str(newest) > str(day):
        raise OutOfOrderBatch(f"batch of {day} is older than versions from {newest}")


def scd2_close(
    dim: DataFrame, batch: DataFrame, keys: list[str], attrs: list[str], day: str | dt.date
) -> DataFrame:
    """``dim`` with the open version of every changed key closed on ``day``."""
    incoming = batch.select(*keys, *attrs).distinct()
    incoming = incoming.select(
        *keys, F.lit(True).alias("_hit"), *[F.col(a).alias(f"_new_{a}") for a in attrs]
    )
    current = dim.filter("is_current").join(incoming, keys, "left")
    close = F.coalesce(F.col("_hit"), F.lit(False)) & changed(
        [F.col(a) for a in attrs], [F.col(f"_new_{a}") for a in attrs]
    )
    after = current.withColumn("_close", close).withColumns(
        {
            "valid_to": F.when(F.col("_close"), F.lit(str(day)).cast("date")),
            "is_current": ~F.col("_close"),
        }
    )
    return dim.filter("NOT is_current").unionByName(after.select(*dim.columns))


def scd2_open(
    dim: DataFrame,
    batch: DataFrame,
    keys: list[str],
    attrs: list[str],
    day: str | dt.date,
    key: str | None = None,
    start: int = 0,
) -> DataFrame:
    """``dim`` plus an open version from ``day`` for every key without one."""
    fresh = without_current(batch.select(*keys, *attrs).distinct(), dim, keys).select(
        *keys,
        *attrs,
        F.lit(str(day)).cast("date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    if key is not None:
        fresh = number_rows(fresh, [*keys, *attrs], key, start)
    return dim.unionByName(fresh.select(*dim.columns))


def scd2_apply_batch(
    dim: DataFrame,
    batch: DataFrame,
    keys: list[str],
    attrs: list[str],
    day: str | dt.date,
    key: str,
    prefer: Column | None = None,
) -> DataFrame:
    """The whole dimension after one day: close and open as one result.

    Refuses a day older than the newest version.  Entities missing from the
    batch keep their open version; a rerun of the same day changes nothing.
    The versions moved are written first, as numbering reads them again.
    """
    refuse_older(dim, day)
    dated = batch.withColumn("_day", F.lit(str(day)).cast("date"))
    moved = materialize(scd2_advance(dim, dated, keys, attrs, "_day", key, prefer), "versions")
    kept = moved.filter(F.col(key).isNotNull())
    opened = number_rows(
        moved.filter(F.col(key).isNull()).drop(key),
        [*keys, "valid_from"],
        key,
        highest_key(dim, key),
    )
    return (
        dim.filter("NOT is_current")
        .unionByName(kept.select(*dim.columns))
        .unionByName(opened.select(*dim.columns))
    )


def scd2_repair(
    dim: DataFrame,
    history: DataFrame,
    batch: DataFrame,
    keys: list[str],
    attrs: list[str],
    day: str | dt.date,
    key: str,
    date: str = "ingest_date",
    prefer: Column | None = None,
) -> DataFrame:
    """The whole dimension after a day that comes late, or again with corrections.

    ``history`` has the observations of the days loaded so far, of this day too
    if it was among them; ``batch`` replaces that day.  Only the timelines of
    keys the day has now or had before are made anew: a version may be split,
    begin or end elsewhere, be opened again, go, or become one with an equal
    neighbour.  All other versions stay as they are, unread but for their key.
    The result equals ``scd2_from_history`` over the corrected days, and a
    version that has its start and attributes from before keeps its surrogate key.

    A day newer than all others that is loaded once needs no history; see
    ``scd2_apply_batch``.
    """
    on_day = F.col(date).eqNullSafe(F.lit(str(day)).cast("date"))
    touched = materialize(
        batch.select(*keys).unionByName(history.filter(on_day).select(*keys)).distinct(), "touched-keys"
    )
    others = history.filter(~on_day).join(touched, keys, "left_semi")
    dated = batch.withColumn(date, F.lit(str(day)).cast("date"))
    seen = _observations(others, keys, attrs, date, prefer).unionByName(
        _observations(dated, keys, attrs, date, prefer)
    )
    made = _versions(seen.withColumn("_open", F.lit(False)), keys, attrs, date, [])
    named = [*keys, *attrs, "valid_from"]
    before = dim.join(touched, keys, "left_semi").select(F.col(key), *[F.col(c).alias(f"_old_{c}") for c in named])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in named])
    # written before numbering, which reads it twice
    matched = materialize(made.join(before, same, "left").select(*dim.columns), "repaired")
    fresh = number_rows(
        matched.filter(F.col(key).isNull()).drop(key), [*keys, "valid_from"], key, highest_key(dim, key)
    )
    return (
        dim.join(touched, keys, "left_anti")
        .select(*dim.columns)
        .unionByName(matched.filter(F.col(key).isNotNull()))
        .unionByName(fresh.select(*dim.columns))
    )
