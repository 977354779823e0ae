"""Surrogate keys without a global sequence."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# New rows are numbered per hash bucket.  The bucket totals are a table of
# this many rows; raise it when one bucket of new keys no longer sorts well.
KEY_BUCKETS = 4096


def number_rows(
    new: DataFrame, natural_key: list[str], key: str, start: int = 0, buckets: int = KEY_BUCKETS
) -> DataFrame:
    """Give each row of ``new`` a distinct integer above ``start``.

    ``natural_key`` must be unique in ``new``.  The numbers depend on the set
    of natural keys alone, so a recomputed task hands out the same ones.
    """
    bucketed = new.withColumn(
        "_bucket", F.pmod(F.xxhash64(*natural_key), F.lit(buckets)).cast("int")
    )
    totals = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # one row per bucket: a bounded window, and a bounded broadcast
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "_bucket", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base")
    )
    inside = Window.partitionBy("_bucket").orderBy(*natural_key)
    return (
        bucketed.join(F.broadcast(bases), "_bucket")
        .withColumn(
            key, F.row_number().over(inside) + F.col("_base") + F.lit(start).cast("bigint")
        )
        .drop("_bucket", "_base")
    )


def highest_key(existing: DataFrame, key: str) -> int:
    """Largest key handed out so far, 0 if none."""
    return existing.agg(F.max(key)).first()[0] or 0


def assign_keys(
    rows: DataFrame, existing: DataFrame, natural_key: list[str], key: str
) -> DataFrame:
    """Keys for ``rows``: known natural keys keep theirs, new ones get the next.

    Reads the largest existing key first (one aggregate row).
    """
    known = existing.select(*natural_key, key)
    kept = rows.join(known, natural_key)
    fresh = rows.join(known, natural_key, "left_anti")
    return kept.unionByName(number_rows(fresh, natural_key, key, highest_key(existing, key)))
