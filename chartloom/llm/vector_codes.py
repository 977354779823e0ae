"""Vectors as short codes: product quantisation over memoised grid cells.

Components become integers, ``floor(SCALE * x)``, and all further arithmetic is
exact.  Vectors are cut into PARTS equal parts.  The codebook of a part starts
as that part of the ENTRIES smallest ids and is moved ROUNDS times: each part
goes to its nearest entry, ties to the lower one, and an entry becomes the floor
of the mean of its parts.  Unused entries stay.

The nearest entry is looked up through a grid.  A part falls into a cell, a box
of WIDTH in each dimension.  An entry whose least distance to the box exceeds
the greatest distance of another one cannot be nearest to any point in it; the
entries that remain are computed once per cell, memoised under a hash of the
cell's coordinates, and only they are evaluated exactly.  Coordinates are kept
and compared, so that a cell of equal hash costs an evaluation of all entries
and nothing else.  The memo belongs to one task
and one codebook, and is emptied when it holds MOST_CELLS cells, which changes
nothing but the time.

Each round is one pass over the vectors: a task sums its own parts per entry and
hands over at most PARTS * ENTRIES rows, so codebooks are the only thing the
driver sees.

Rows whose vector is null or holds null or non-finite components are dropped.
All vectors have the length that most of them have, the larger of equally many;
rows of other lengths, and of lengths that cannot be cut into PARTS parts, are
dropped too.  Vectors of length 0 have the code of zeros and no error.
Components beyond +-LIMIT / SCALE count as that, so that squares fit a long.
Rows are rows: repeated ids and repeated rows each count.  The first entries are
taken by id, then by vector; null ids come last.  With fewer rows than ENTRIES
there are fewer entries.  Null labels are one label.  Ids and labels may have
any type that can be ordered and compared; other columns are not read.  An empty
table gives an empty one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import BROADCAST_ROWS, materialize, same
from chartloom.llm.spans import mix, powers

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
LIMIT = 1 << 24
# Edge of a grid cell, in integer units, and cells a task remembers per part.
WIDTH, MOST_CELLS = 192, 1 << 16


def whole_vector(column: str) -> Column:
    """False for vectors that are null or hold null or non-finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return F.coalesce(F.forall(column, finite), F.lit(False))


def integer_vector(column: str) -> Column:
    def scaled(x: Column) -> Column:
        wide = F.least(F.greatest(x.cast("double") * SCALE, F.lit(float(-LIMIT))), F.lit(float(LIMIT)))
        return F.floor(wide).cast("int")

    return F.transform(column, scaled)


def integer_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, v) of the rows that are kept, written."""
    named = vectors.select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v")
    )
    whole = named.filter(whole_vector("v")).withColumn("v", integer_vector("v"))
    written = materialize(whole, "integer-vectors")
    size = F.size("v")
    usual = (
        written.filter(size % PARTS == 0)
        .groupBy(size.alias("length"))
        .count()
        .orderBy(F.desc("count"), F.desc("length"))
        .first()
    )
    return written.filter(size == F.lit(usual["length"] if usual else -1))


class CellMemo:
    """Nearest entries of one part's codebook."""

    def __init__(self, book: np.ndarray, width: int = WIDTH, most_cells: int = MOST_CELLS):
        self.book, self.width, self.most_cells = book, width, most_cells
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)  # hashes of the cells, ascending
        self.cells = np.zeros((0, self.book.shape[1]), dtype=np.int64)
        self.open = np.zeros((0, len(self.book)), dtype=bool)

    def undominated(self, cells: np.ndarray) -> np.ndarray:
        """Per cell, the entries that may be nearest to a point in its box."""
        low = (cells * self.width)[:, None, :]
        high = low + self.width - 1
        below, above = low - self.book, self.book - high
        least = np.maximum(np.maximum(below, above), 0)
        greatest = np.maximum(np.abs(below), np.abs(above))
        return (least**2).sum(axis=2) <= (greatest**2).sum(axis=2).min(axis=1, keepdims=True)

    def open_entries(self, parts: np.ndarray) -> np.ndarray:
        """Per part, the entries to evaluate; new cells are remembered."""
        cells = parts // self.width
        hashes = mix(cells.astype(np.uint64) @ powers(cells.shape[1]))
        keys, example, number = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.most_cells:
            self._clear()
        fresh = ~np.isin(keys, self.keys, assume_unique=True)
        if fresh.any():
            added = cells[example[fresh]]
            merged = np.concatenate((self.keys, keys[fresh]))
            order = np.argsort(merged)
            self.keys = merged[order]
            self.cells = np.concatenate((self.cells, added))[order]
            self.open = np.concatenate((self.open, self.undominated(added)))[order]
        places = np.searchsorted(self.keys, keys)[number]
        found = self.open[places]
        found[(self.cells[places] != cells).any(axis=1)] = True  # another cell of equal hash
        return found

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each part and the squared distance to it."""
        if not parts.size:
            return np.zeros(len(parts), dtype=np.int64), np.zeros(len(parts), dtype=np.int64)
        row, entry = np.nonzero(self.open_entries(parts))
        distance = ((parts[row] - self.book[entry]) ** 2).sum(axis=1)
        begins = np.flatnonzero(np.diff(row, prepend=-1))
        least = np.minimum.reduceat(distance, begins)
        # entries ascend within a row: the first of the nearest is the lowest
        tied = np.flatnonzero(distance == least[row])
        chosen = tied[np.diff(row[tied], prepend=-1) > 0]
        return entry[chosen], least


def _cut(vectors: pa.Array) -> np.ndarray:
    """Arrow lists of equal length as an array of (row, part, component)."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.reshape(len(vectors), PARTS, len(flat) // (PARTS * len(vectors)))


# Rows a task handles at a time.
_ROWS = 4096


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            yield batch.slice(start, _ROWS)


@dataclass(frozen=True)
class Codebooks:
    """The entries of all parts: an array of (part, entry, component)."""

    entries: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def sums(self, whole: DataFrame) -> DataFrame:
        """Per task, part and used entry: the sum of its parts, and their number at the end."""
        entries = self.entries

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            memos = [CellMemo(book) for book in entries]
            total = np.zeros((*entries.shape[:2], entries.shape[2] + 1), dtype=np.int64)
            for batch in _runs(batches):
                vectors = _cut(batch["v"])
                for part, memo in enumerate(memos):
                    chosen, _ = memo.nearest(vectors[:, part])
                    np.add.at(total[part, :, :-1], chosen, vectors[:, part])
                    total[part, :, -1] += np.bincount(chosen, minlength=entries.shape[1])
            part, entry = np.nonzero(total[:, :, -1])
            columns = [pa.array(part), pa.array(entry), pa.array(list(total[part, entry]), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "entry", "total"])

        return whole.select("v").mapInArrow(run, "part long, entry long, total array<long>")

    def moved(self, whole: DataFrame) -> Codebooks:
        """Entries at the floor of the mean of their parts."""
        flat = self.sums(whole).select("part", "entry", F.posexplode("total").alias("place", "value"))
        summed = flat.groupBy("part", "entry", "place").agg(F.sum("value").alias("value")).collect()
        total = np.zeros((*self.entries.shape[:2], self.entries.shape[2] + 1), dtype=np.int64)
        for row in summed:  # one for each integer of the codebooks
            total[row.part, row.entry, row.place] = row.value
        number = total[:, :, -1:]
        return Codebooks(np.where(number > 0, total[:, :, :-1] // np.maximum(number, 1), self.entries))

    def encoded(self, whole: DataFrame) -> DataFrame:
        """(vec_id, label, code, error) per row."""
        entries = self.entries
        types = {name: whole.schema[name].dataType.simpleString() for name in ("vec_id", "label")}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            memos = [CellMemo(book) for book in entries]
            for batch in _runs(batches):
                vectors = _cut(batch["v"])
                found = [memo.nearest(vectors[:, part]) for part, memo in enumerate(memos)]
                codes = np.stack([chosen for chosen, _ in found], axis=1).astype(np.uint8)
                error = sum(distance for _, distance in found)
                columns = [batch["vec_id"], batch["label"], pa.array([c.tobytes().hex() for c in codes]), pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "code", "error"])

        schema = f"vec_id {types['vec_id']}, label {types['label']}, code string, error long"
        return whole.select("vec_id", "label", "v").mapInArrow(run, schema)


def first_codebooks(whole: DataFrame) -> Codebooks:
    """The parts of the smallest ids."""
    rows = whole.select("vec_id", "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(ENTRIES).collect()
    length = len(rows[0].v) if rows else 0
    vectors = np.array([row.v for row in rows], dtype=np.int64)
    return Codebooks(vectors.reshape(len(rows), PARTS, length // PARTS).transpose(1, 0, 2).copy())


def with_label_error(coded: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Add the error summed over the rows of equal label.

    With many labels, those that hold more than one row in ``broadcast_rows``
    are broadcast, and there can be no more of them than that; the others join
    by shuffle, where no key is frequent.
    """
    sums = materialize(
        coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("_rows")), "label-errors"
    )
    if sums.count() <= broadcast_rows:
        return coded.join(F.broadcast(sums), same(coded, sums, "label")).select(coded["*"], "label_error")
    least = coded.count() // broadcast_rows
    heavy, light = sums.filter(F.col("_rows") > least), sums.filter(F.col("_rows") <= least)
    often = coded.join(F.broadcast(heavy), same(coded, heavy, "label")).select(coded["*"], "label_error")
    few = coded.join(F.broadcast(heavy), same(coded, heavy, "label"), "left_anti")
    return often.unionByName(few.join(light, same(few, light, "label")).select(few["*"], "label_error"))


def train(whole: DataFrame) -> Codebooks:
    books = first_codebooks(whole)
    for _ in range(ROUNDS if books.entries.size else 0):
        books = books.moved(whole)
    return books


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error, label_error) per kept row, and the codebooks."""
    whole = integer_vectors(vectors, id_col, vector_col, label_col)
    books = train(whole)
    coded = materialize(books.encoded(whole), "vector-codes")
    return with_label_error(coded), books
