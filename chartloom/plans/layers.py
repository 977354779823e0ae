"""Tables kept as a base and layers of changes over it.

A layer is a folder of whole rows.  In a keyed table the newest layer that has
a key holds its row; in any other table all rows count.  A load adds one layer
per table, as large as what the load touched, whatever the size of the table.

Layers are merged when the newer ones together have as many rows as the next
older one.  A row is thus written again only when the rows over it have doubled,
so a table of n rows has about log2(n) layers at most, and a row costs as many
writes over its life.  The base itself is rewritten once the changes since are
as large as it is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def all_rows(layers: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, layers)


def _newest(layers: list[DataFrame], keys: list[str]) -> DataFrame:
    """The row of the last layer for each key; a layer has a key once."""
    columns = layers[0].columns
    numbered = all_rows([layer.withColumn("_layer", F.lit(i)) for i, layer in enumerate(layers)])
    newest = F.max_by(F.struct(*columns), "_layer").alias("_row")
    return numbered.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(newest).select("_row.*")


def newest_rows(layers: list[DataFrame], keys: list[str]) -> DataFrame:
    """A keyed table as of its last layer.

    The base is not grouped: its rows pass unless a layer over it has their key.
    """
    base, *later = layers
    if not later:
        return base
    touched = all_rows([layer.select(*keys) for layer in later]).distinct()
    return base.join(touched, keys, "left_anti").unionByName(_newest(later, keys).select(*base.columns))


def rows_of_keys(layers: list[DataFrame], keys: list[str], wanted: DataFrame) -> DataFrame:
    """The current rows of some keys; those of others leave the plan at the scan."""
    met = [layer.join(wanted, keys, "left_semi") for layer in layers]
    return met[0] if len(met) == 1 else _newest(met, keys)


def merge_from(sizes: list[int]) -> int | None:
    """The first layer to merge with all later ones, or None."""
    over = 0
    found = None
    for place in range(len(sizes) - 1, -1, -1):
        if over and sizes[place] <= over:
            found = place
        over += sizes[place]
    return found
