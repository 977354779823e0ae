"""Substring deduplication by seed and extend, exact and without pairs.

A window is a run of ``window`` words of one document.  Its anchor is the seed
(run of ``seed`` words) of smallest hash inside it, the leftmost of equals; as
only the window's own words decide, equal windows have equal anchors.

*Seed.*  Consecutive windows with the same anchor form a segment, so a document
is listed as (anchor hash, segment).  Only anchors that more than one document
holds can carry a repeat; they are found by aggregation.

*Extend.*  An anchor is extended both ways to the whole segment around it.
Equal extended segments are one class, and every member but those with the
smallest doc_id repeats it in full.  What extends only part of the way differs
between classes of one anchor: for one representative per class (the others
already follow it) the windows themselves are compared.  Adjacent repeated
windows join into maximal repeats when the words are cut out.

All steps are aggregations and equi-joins whose rows are proportional to the
input; a passage shared by many documents is never expanded into pairs.

Null and empty texts have no words and nothing removed.  A null doc_id is
larger than any other, rows with one doc_id never repeat each other.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import materialize, text_slices
from chartloom.llm.spans import BASE, code_points, hash_spans, mix, power_series, powers, word_spans

WINDOW, SEED = 50, 25
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST_ID = 2**63 - 1
DOC = ["ord", "th"]
OTHER = np.uint64(0xD1B54A32D192ED03)
UNBASE = np.uint64(pow(int(BASE), -1, 2**64))


class WordHashes:
    """Hashes of any run of words in a batch of texts, by prefix sums."""

    def __init__(self, texts: list[str]):
        codes, begins = code_points(texts)
        starts, ends = word_spans(codes)
        #: index of the first word of each text, and one past the last
        self.first = np.searchsorted(starts, begins)
        words = hash_spans(codes, starts, ends)
        self.n = len(words)
        base = powers(self.n + 1)
        self.unshift = power_series(UNBASE, self.n + 1)
        self.sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(w * base[:-1], dtype=np.uint64))) for w in (words, mix(words ^ OTHER))]

    def runs(self, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
        s = self.sums[which]
        return mix((s[ends] - s[starts]) * self.unshift[starts])


def _leftmost_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """For each i the place of the smallest of values[i : i + width]."""
    at, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        left, right = at[:-step], at[step:]
        at = np.where(values[left] <= values[right], left, right)
        span += step
    return at


def segments(texts: list[str], window: int = WINDOW, seed: int = SEED) -> dict[str, np.ndarray]:
    """Anchor hash, segment hash and place of every segment of the texts."""
    w = WordHashes(texts)
    empty = {k: np.zeros(0, t) for k, t in (("row", np.int64), ("anchor", np.uint64), ("g1", np.uint64), ("g2", np.uint64), ("start", np.int64), ("n", np.int64))}
    if w.n < window:
        return empty
    at = np.arange(w.n - seed + 1)
    seeds = w.runs(at, at + seed)
    anchors = _leftmost_minimum(seeds, window - seed + 1)  # one per window start
    row = np.searchsorted(w.first, np.arange(len(anchors)), side="right") - 1
    whole = np.arange(len(anchors)) + window <= w.first[row + 1]
    starts = np.flatnonzero(whole)
    if not len(starts):
        return empty
    fresh = np.concatenate(([True], (anchors[starts[1:]] != anchors[starts[:-1]]) | (row[starts[1:]] != row[starts[:-1]])))
    begin = starts[fresh]
    count = np.diff(np.concatenate((np.flatnonzero(fresh), [len(starts)])))
    end = begin + count - 1 + window
    return {
        "row": row[begin],
        "anchor": seeds[anchors[begin]],
        "g1": w.runs(begin, end),
        "g2": w.runs(begin, end, 1),
        "start": begin - w.first[row[begin]],
        "n": count,
    }


def _list_segments(window: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            found = segments(texts, window, seed)
            row = pa.array(found["row"])
            yield pa.RecordBatch.from_arrays(
                [
                    part["ord"].take(row),
                    part["th"].take(row),
                    *(pa.array(found[k].view(np.int64)) for k in ("anchor", "g1", "g2")),
                    *(pa.array(found[k].astype(np.int32)) for k in ("start", "n")),
                ],
                names=["ord", "th", "anchor", "g1", "g2", "start", "n"],
            )

    return run


def _list_windows(window: int):
    """Both hashes of every window of the listed segments of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            w = WordHashes(texts)
            row, start = [], []
            for i, runs in enumerate(part["runs"].to_pylist()):
                for run in runs:
                    at = np.arange(run["start"], run["start"] + run["n"])
                    start.append(at)
                    row.append(np.full(len(at), i))
            row, start = np.concatenate(row), np.concatenate(start)
            at = start + w.first[row]
            yield pa.RecordBatch.from_arrays(
                [
                    part["ord"].take(pa.array(row)),
                    part["th"].take(pa.array(row)),
                    pa.array(start.astype(np.int32)),
                    *(pa.array(w.runs(at, at + window, k).view(np.int64)) for k in (0, 1)),
                ],
                names=["ord", "th", "start", "w1", "w2"],
            )

    return run


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            n_words, n_removed, kept = [], [], []
            for text, runs in zip(texts, part["runs"].to_pylist()):
                words = WORD.findall(text)
                n_words.append(len(words))
                if runs:
                    change = np.zeros(len(words) + 1, dtype=np.int32)
                    for run in runs:
                        change[run["start"]] += 1
                        change[run["start"] + run["n"] - 1 + window] -= 1
                    stay = np.cumsum(change[:-1]) == 0
                    words = [word for word, yes in zip(words, stay.tolist()) if yes]
                n_removed.append(n_words[-1] - len(words))
                kept.append(" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.large_string() if part.schema.field("text").type == pa.large_string() else pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, seed: int = SEED) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_words, n_removed and the kept text.

    A word goes if some window over it also starts in a document with a
    smaller doc_id; kept words are joined by one space.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select(
        "doc_id",
        "text",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("ord"),
        F.xxhash64("text").alias("th"),
    )
    listed = materialize(
        keyed.select("ord", "th", "text").mapInArrow(
            _list_segments(window, seed), "ord long, th long, anchor long, g1 long, g2 long, start int, n int"
        ),
        "segments",
    )
    shared = (
        listed.groupBy("anchor")
        .agg(F.min("ord").alias("a"), F.max("ord").alias("z"), F.min("g1").alias("ga"), F.max("g1").alias("gz"))
        .filter("a <> z")
        .select("anchor", (F.col("ga") != F.col("gz")).alias("varied"))
    )
    seeds = materialize(listed.join(shared, "anchor"), "shared-anchors")
    classes = seeds.groupBy("g1", "g2").agg(F.min("ord").alias("first"))
    classed = materialize(
        seeds.join(classes, ["g1", "g2"]).select(*DOC, "start", "n", "varied", (F.col("first") < F.col("ord")).alias("repeat")),
        "classes",
    )
    by_doc = keyed.select("ord", "th", "text")
    open_runs = classed.filter("varied and not repeat").groupBy(*DOC).agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    windows = materialize(
        by_doc.join(open_runs, DOC)
        .select(*DOC, "text", "runs")
        .mapInArrow(_list_windows(window), "ord long, th long, start int, w1 long, w2 long"),
        "windows",
    )
    first = windows.groupBy("w1", "w2").agg(F.min("ord").alias("first"), F.max("ord").alias("last")).filter("first <> last")
    late = windows.join(first, ["w1", "w2"]).filter("first < ord").select(*DOC, "start", F.lit(1).alias("n"))
    runs = (
        classed.filter("repeat")
        .select(*DOC, "start", "n")
        .unionByName(late)
        .distinct()
        .groupBy(*DOC)
        .agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    )
    return (
        keyed.join(runs, DOC, "left")
        .select("doc_id", "text", "runs")
        .mapInArrow(_cut(window), f"doc_id {id_type}, n_words long, n_removed long, kept string")
    )
