"""Joins against keyed lookups and single-version dimensions.

No broadcast hints: a lookup read from files or shrunk by an aggregate is
broadcast by the planner when its size is under the threshold, and joined by
shuffle when it is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class AbsentLookup(LookupError):
    """There is no lookup to name anything by."""


def lookup_union_last(
    entries: DataFrame, key: str, order: list[Column | str]
) -> DataFrame:
    """One entry per key: the last one in ``order`` wins.

    A region whose fetch failed simply has no rows here.
    """
    body = [c for c in entries.columns if c != key]
    last = F.max_by(F.struct(*body), F.struct(*order)).alias("_last")
    return entries.groupBy(key).agg(last).select(key, *[f"_last.{c}" for c in body])


def lookup_versions(
    entries: DataFrame,
    fetches: DataFrame,
    key: str = "id",
    date: str = "fetched_date",
    order: list[Column | str] = ("place",),
) -> DataFrame:
    """Entries of dated lookups with the period in which they hold.

    Each fetch replaces the whole lookup until the next one, so an id that a
    fetch lacks has no entry for that time.  Within a fetch the last entry of
    an id in ``order`` wins.  Equal neighbours are one period; the last period
    has no ``valid_to``.  ``fetches`` has the dates, also of empty fetches; the
    windows hold one row per fetch.
    """
    body = [c for c in entries.columns if c not in (key, date, *map(str, order))]
    last = F.max_by(F.struct(*body), F.struct(*order)).alias("_body")
    single = entries.filter(F.col(date).isNotNull()).groupBy(date, key).agg(last)
    dates = fetches.select(date).filter(F.col(date).isNotNull()).distinct()
    spans = dates.withColumn("_next", F.lead(date).over(Window.orderBy(date)))
    by_key = Window.partitionBy(key).orderBy(date)
    goes_on = F.lag("_next").over(by_key).eqNullSafe(F.col(date)) & F.lag("_body").over(by_key).eqNullSafe(
        F.col("_body")
    )
    marked = single.join(spans, date).withColumn("_starts", F.when(goes_on, 0).otherwise(1))
    return (
        marked.withColumn("_period", F.sum("_starts").over(by_key))
        .groupBy(key, "_period")
        .agg(
            F.first("_body").alias("_body"),
            F.min(date).alias("valid_from"),
            F.max_by("_next", date).alias("valid_to"),
        )
        .select(key, *[f"_body.{c}" for c in body], "valid_from", "valid_to")
    )


def valid_on(versions: DataFrame, day: object) -> DataFrame:
    """The entries that hold on one day, without their period."""
    on = F.lit(str(day)).cast("date")
    holds = (F.col("valid_from") <= on) & (F.col("valid_to").isNull() | (F.col("valid_to") > on))
    return versions.filter(holds).drop("valid_from", "valid_to")


def lookup_as_of(
    df: DataFrame,
    versions: DataFrame,
    key: str,
    date: str,
    value: str,
    default: str = "UNKNOWN",
    lookup_key: str = "id",
    out: str = "category_name",
) -> DataFrame:
    """Left lookup by id, as it was on each row's date; ids without an entry get ``default``.

    ``versions`` come from ``lookup_versions``; periods of an id do not
    overlap, so rows are never multiplied.  Without any lookup this raises, and
    a row older than the first lookup fails the job: neither is an unknown id.
    Reads the first date (one aggregate row).
    """
    first = versions.agg(F.min("valid_from")).first()[0]
    if first is None:
        raise AbsentLookup(f"no lookup for {key}")
    periods = versions.select(
        F.col(lookup_key).alias("_id"),
        F.col(value).alias("_value"),
        F.col("valid_from").alias("_from"),
        F.col("valid_to").alias("_to"),
    )
    holds = (
        (F.col(key) == F.col("_id"))
        & (F.col("_from") <= F.col(date))
        & (F.col("_to").isNull() | (F.col("_to") > F.col(date)))
    )
    early = F.concat(F.lit(f"no lookup for {key} before {first}; a row is of "), F.col(date).cast("string"))
    named = F.when(F.col(date) < F.lit(first), F.raise_error(early)).otherwise(
        F.coalesce("_value", F.lit(default))
    )
    return df.join(periods, holds, "left").withColumn(out, named).drop("_id", "_value", "_from", "_to")


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    value: str,
    default: str = "UNKNOWN",
    lookup_key: str = "id",
    out: str = "category_name",
    order: list[Column | str] = (),
) -> DataFrame:
    """Left lookup by id in one undated table; ids without an entry get ``default``.

    Of several entries of an id the last in ``order`` counts; without an order
    the greatest value does.
    """
    # one value per id, so the join cannot multiply rows
    chosen = F.max_by(value, F.struct(*order)) if order else F.max(value)
    single = lookup.groupBy(F.col(lookup_key).alias("_id")).agg(chosen.alias("_value"))
    return (
        df.join(single, F.col(key) == F.col("_id"), "left")
        .withColumn(out, F.coalesce("_value", F.lit(default)))
        .drop("_id", "_value")
    )


def lookup_unmatched(
    df: DataFrame, lookup: DataFrame, key: str, lookup_key: str = "id"
) -> DataFrame:
    """Ids (NULL included) that the lookup lacks, with their row counts."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    known = lookup.select(F.col(lookup_key).alias("_id"))
    return counted.join(known, F.col(key) == F.col("_id"), "left_anti").orderBy(
        F.asc_nulls_first(key)
    )


def dim_key_resolve(
    facts: DataFrame,
    dim: DataFrame,
    natural_key: str,
    key: str,
    fact_key: str | None = None,
    how: str = "inner",
) -> DataFrame:
    """Add a dimension's surrogate key by natural key; unmatched rows drop out, or have none in a left join."""
    small = dim.select(F.col(natural_key).alias("_nk"), key)
    return facts.join(small, F.col(fact_key or natural_key) == F.col("_nk"), how).drop("_nk")


def region_names(df: DataFrame, dim_region: DataFrame, region: str = "region_code") -> DataFrame:
    """Add the display name of each region code; unknown codes keep NULL."""
    names = dim_region.select(F.col("region_code").alias("_code"), "region_name")
    return df.join(names, F.col(region) == F.col("_code"), "left").drop("_code")
