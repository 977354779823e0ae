"""Row numbers and running totals that never put one list into one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.session import materialize

# Pages per block in running totals: a window never holds more rows than this
# inside a block, and sees one row per block above it.
PAGE_BLOCK = 4096
# Low bits of monotonically_increasing_id(): the row's number in its partition.
_ROW_BITS = 33


def list_positions(
    df: DataFrame, by: list[str], order: list[Column], out: str = "position"
) -> DataFrame:
    """Exact row number from 1 of every row in its list.

    ``order`` must be unique inside a list.  A window over ``by`` alone would
    sort a whole list in one task.  Here the rows are cut into even ranges of
    (list, order), sorted and numbered inside each range, and shifted by the
    places of their list in the ranges before.  The ranges are written first:
    they come from a sample, and both the sizes and the rows have to see the
    same cut.  Only that cut moves whole rows.
    """
    part, row = "_range", "_row"
    ranged = materialize(
        df.repartitionByRange(*[F.col(c) for c in by], *order)
        .sortWithinPartitions(*[F.col(c) for c in by], *order)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn(part, F.shiftright("_id", _ROW_BITS).cast("int"))
        .withColumn(row, F.col("_id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_id"),
        "ranges",
    )
    sizes = ranged.groupBy(*by, part).agg(F.count(F.lit(1)).alias("_rows"), F.min(row).alias("_first"))
    # one row per list and range it touches
    earlier = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        F.col(part).alias("_of_range"),
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    # One row per list and cut inside one; written, so that the planner knows
    # whether they are few enough to be broadcast.
    shifts = materialize(shifts, "range-shifts")
    same_list = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by]
    shifted = ranged.join(shifts, reduce(lambda a, b: a & b, same_list, F.col(part) == F.col("_of_range")))
    position = F.col(row) + F.lit(1) + F.col("_shift")
    return shifted.select(*df.columns, position.cast("bigint").alias(out))


def running_offsets(
    sized: DataFrame, by: list[str], page: str, size: str, out: str = "offset"
) -> DataFrame:
    """Sum of ``size`` over the earlier pages of the same list, per page.

    Two levels: totals of page blocks, then pages inside their block, so a
    list of any length is spread over its blocks.
    """
    blocked = sized.withColumn("_block", F.floor(F.col(page) / PAGE_BLOCK))
    before = lambda *keys: (
        Window.partitionBy(*by, *keys).rowsBetween(Window.unboundedPreceding, -1)
    )
    blocks = (
        blocked.groupBy(*by, "_block")
        .agg(F.sum(size).alias("_total"))
        .withColumn(
            "_base", F.coalesce(F.sum("_total").over(before().orderBy("_block")), F.lit(0))
        )
        .drop("_total")
    )
    return (
        blocked.join(blocks, [*by, "_block"])
        .withColumn(
            out,
            F.col("_base")
            + F.coalesce(F.sum(size).over(before("_block").orderBy(page)), F.lit(0)),
        )
        .drop("_block", "_base")
    )
