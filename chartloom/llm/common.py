"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.session import materialize

# Rows a side may have to be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000
# Characters of text that a Python task handles at a time.
BATCH_CHARS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def rows_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of any table; other columns are left out of the scan."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def same(left: DataFrame, right: DataFrame, *columns: str) -> Column:
    """Equality of the named columns, where null equals null."""
    return reduce(lambda a, b: a & b, (left[c].eqNullSafe(right[c]) for c in columns))


def small_or_not(written: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a written table for broadcast if it has at most ``rows`` rows.

    The count comes from file footers.  A larger one is returned as it is and
    joins by shuffle, with the same result.
    """
    return F.broadcast(written) if written.count() <= rows else written


def text_slices(
    batches: Iterable[pa.RecordBatch], text_col: str = "text", chars: int = BATCH_CHARS
) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut Arrow batches into runs of rows with about ``chars`` characters.

    A longer text is a run of its own.  Null texts come as empty strings.
    """
    for batch in batches:
        sizes = [n or 0 for n in pc.binary_length(batch[text_col]).to_pylist()]
        start = held = 0
        for row, size in enumerate(sizes):
            if row > start and held + size > chars:
                yield _slice(batch, text_col, start, row)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield _slice(batch, text_col, start, batch.num_rows)


def _slice(batch, text_col, start, end):
    part = batch.slice(start, end - start)
    return part, [t or "" for t in part[text_col].to_pylist()]


__all__ = [
    "BATCH_CHARS",
    "BROADCAST_ROWS",
    "materialize",
    "rows_of",
    "same",
    "small_or_not",
    "table",
    "text_slices",
]
