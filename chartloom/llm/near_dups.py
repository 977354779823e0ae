"""Near-duplicate documents by ProbMinHash.

A document is a distribution over its shingles of five words, each weighted by
how often it occurs.  Each shingle draws the points of a Poisson process whose
rate is its weight, from its own hash alone; each point falls on one of the
registers, and a register keeps the shingle with the earliest point.  Two
documents agree in a register with the probability Jaccard similarity of their
distributions.  Points are drawn in order for all shingles of a batch at once,
and a shingle stops as soon as its next point comes after every register is
taken by an earlier one.

Bands of registers propose candidates, :mod:`chartloom.llm.components` links
them without pairing whole groups, and each link is verified on the full texts:
probability Jaccard of at least ``threshold`` over all shingles.  Leaders of
buckets are the texts that share most buckets.  Texts that are still in different
groups after that get a second, larger set of registers, of which two bits each
are kept; pairs whose sketches tell that they are far below the threshold (a
pair at it fails with a probability of 0.0001) are not verified.  Exact copies
are collapsed beforehand and share the class of the text.

Words are runs of characters other than blanks, unchanged.  Texts of one to four
words are a single shingle; null texts and texts without a word are each their
own class.  Rows that share a doc_id are one document; a null doc_id is told by
its text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import materialize, small_or_not, text_slices
from chartloom.llm.components import link_buckets
from chartloom.llm.spans import BASE, code_points, hash_spans, mix, word_spans

WORDS, THRESHOLD = 5, 0.8
# A similarity that is the threshold may come out less by rounding of its sum.
ROUNDING = 1e-9
# A pair at the threshold shares a band with probability 1 - (1 - 0.8 ** 6) ** 24 = 0.999.
BANDS, ROWS = 24, 6
REGISTERS = BANDS * ROWS
# Registers of a sketch, the bits kept of each, and the standard deviations of an
# estimate that a pair may lie below the threshold.
SKETCHED, SKETCH_BITS, DEVIATIONS = 1024, 2, 3.7
# Open pairs for each row of a bucket that sketches may sort out at once.
OPEN_PER_ROW = 100
PAIRS_PER_SALT = 200
DRAWS = 1 << 16


def shingles(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts as (text number, hash, times), sorted by text."""
    codes, begins = code_points(texts)
    at, end = word_spans(codes)
    first = np.searchsorted(at, begins)
    h = hash_spans(codes, at, end)
    count = np.diff(first)
    each = np.where(count >= words, count - words + 1, (count > 0).astype(np.int64))
    text = np.repeat(np.arange(len(texts)), each)
    start = np.repeat(first[:-1] - (np.cumsum(each) - each), each) + np.arange(each.sum())
    value = np.zeros(len(start), dtype=np.uint64)
    last = first[1:][text]
    for k in range(words):
        inside = start + k < last
        value = mix(value * BASE + np.where(inside, h[np.minimum(start + k, max(len(h) - 1, 0))] if len(h) else 0, np.uint64(k)))
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    fresh = np.ones(len(text), dtype=bool)
    fresh[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    edges = np.flatnonzero(fresh)
    return text[edges], value[edges], np.diff(np.append(edges, len(text)))


def _draw(element: np.ndarray, point: np.ndarray, registers: int) -> tuple[np.ndarray, np.ndarray]:
    """Waiting time at unit rate, and register, of a numbered point of each element."""
    random = mix(element + (point.astype(np.uint64) + np.uint64(1)) * BASE)
    wait = -np.log(((random >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
    return wait, (mix(random ^ BASE) % np.uint64(registers)).astype(np.int64)


def signatures(texts: list[str], registers: int = REGISTERS) -> tuple[np.ndarray, np.ndarray]:
    """Registers of each text, and whether it has any shingle."""
    text, value, times = shingles(texts)
    earliest = np.full(len(texts) * registers, np.inf)
    holder = np.zeros(len(texts) * registers, dtype=np.uint64)
    now = np.zeros(len(text))
    point = np.zeros(len(text), dtype=np.int64)
    active = np.arange(len(text))
    while len(active):
        # a few points at once where few shingles are left
        ahead = int(min(256, max(1, DRAWS // len(active))))
        number = point[active][:, None] + np.arange(ahead)
        wait, register = _draw(np.repeat(value[active], ahead), number.ravel(), registers)
        rate = np.repeat(times[active], ahead)
        came = (np.repeat(now[active], ahead).reshape(-1, ahead) + np.cumsum((wait / rate).reshape(-1, ahead), axis=1)).ravel()
        cell = np.repeat(text[active], ahead) * registers + register
        early = np.flatnonzero(came <= earliest[cell])
        np.minimum.at(earliest, cell[early], came[early])
        won = early[came[early] == earliest[cell[early]]]
        holder[cell[won]] = np.repeat(value[active], ahead)[won]
        now[active] = came.reshape(-1, ahead)[:, -1]
        point[active] += ahead
        latest = earliest.reshape(-1, registers).max(axis=1)
        active = active[now[active] < latest[text[active]]]
    some = np.zeros(len(texts), dtype=bool)
    some[text] = True
    return holder.reshape(-1, registers), some


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; keys of different bands do not meet."""
    parts = registers.reshape(len(registers), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for r in range(ROWS):
        key = mix(key * BASE + parts[:, :, r])
    return key


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_slices(batches):
        registers, some = signatures(texts)
        kept = np.flatnonzero(some)
        keys = band_keys(registers[kept]).astype(np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [part["node"].take(pa.array(kept)), pa.array(list(keys), pa.list_(pa.int64()))], names=["node", "keys"]
        )


def sketches(holder: np.ndarray) -> np.ndarray:
    """The lowest bits of the registers, plane by plane, as 64-bit values."""
    planes = [np.packbits(((holder >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), axis=1) for b in range(SKETCH_BITS)]
    return np.ascontiguousarray(np.hstack(planes)).view(np.int64)


def _sketch(texts: DataFrame):
    """The sketches of some nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, some in text_slices(batches):
            rows = sketches(signatures(some, SKETCHED)[0])
            yield pa.RecordBatch.from_arrays([part["node"], pa.array(list(rows), pa.list_(pa.int64()))], names=["node", "sketch"])

    def sketch(nodes: DataFrame) -> DataFrame:
        wanted = small_or_not(materialize(nodes, "open-nodes"))
        found = texts.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("text").alias("text"))
        return found.mapInArrow(run, "node long, sketch array<long>")

    return sketch


def _alike(threshold: float):
    """Whether two sketches agree in about as many registers as a pair at the threshold."""
    longs = SKETCHED // 64
    agree = threshold + (1 - threshold) / (1 << SKETCH_BITS)
    most = int(SKETCHED * (1 - agree) + DEVIATIONS * (SKETCHED * agree * (1 - agree)) ** 0.5)

    def alike(one: str, other: str) -> Column:
        def differ(k: int) -> Column:
            return F.get(one + "sketch", F.lit(k)).bitwiseXOR(F.get(other + "sketch", F.lit(k)))

        planes = [[differ(b * longs + k) for b in range(SKETCH_BITS)] for k in range(longs)]
        return sum(F.bit_count(reduce(Column.bitwiseOR, p)) for p in planes) <= most

    return alike


def probability_jaccard(left: list[str], right: list[str]) -> np.ndarray:
    """Exact probability Jaccard similarity of the shingles of each pair of texts.

    It is the sum over common shingles x of 1 / sum over y of
    max(a[y] / a[x], b[y] / b[x]).  With the shingles of a pair in order of
    a / b, the left term is the larger one from x on and the right one before.
    """
    n = len(left)
    text, value, times = shingles([*left, *right])
    pair, side = text % n, text >= n
    order = np.lexsort((side, value, pair))
    pair, value, side, times = pair[order], value[order], side[order], times[order]
    fresh = np.ones(len(pair), dtype=bool)
    fresh[1:] = (pair[1:] != pair[:-1]) | (value[1:] != value[:-1])
    slot = np.cumsum(fresh) - 1
    a, b = np.zeros(fresh.sum()), np.zeros(fresh.sum())
    a[slot[~side]], b[slot[side]] = times[~side], times[side]
    pair = pair[fresh]
    ratio = np.divide(a, b, out=np.full(len(a), np.inf), where=b > 0)
    order = np.lexsort((ratio, pair))
    a, b, pair, ratio = a[order], b[order], pair[order], ratio[order]
    begin = np.searchsorted(pair, np.arange(n + 1))
    sum_a, sum_b = np.concatenate(([0], np.cumsum(a))), np.concatenate(([0], np.cumsum(b)))
    # first place in the pair with the same ratio
    run = np.ones(len(a), dtype=bool)
    run[1:] = (pair[1:] != pair[:-1]) | (ratio[1:] != ratio[:-1])
    from_x = np.maximum.accumulate(np.where(run, np.arange(len(a)), 0))
    common = np.flatnonzero((a > 0) & (b > 0))
    x, p = from_x[common], pair[common]
    total = (sum_a[begin[p + 1]] - sum_a[x]) / a[common] + (sum_b[x] - sum_b[begin[p]]) / b[common]
    return np.bincount(p, 1 / total, minlength=n)


def _verify(texts: DataFrame, threshold: float):
    """Keeps the pairs (u, v) whose texts are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, left in text_slices([batch], "left"):
                similar = probability_jaccard(left, [t or "" for t in part["right"].to_pylist()]) >= threshold - ROUNDING
                yield part.select(["u", "v"]).filter(pa.array(similar))

    def verify(pairs: DataFrame) -> DataFrame:
        # a leader with many partners is dealt out in portions
        load = pairs.groupBy("u").agg(F.ceil(F.count("*") / PAIRS_PER_SALT).cast("int").alias("salts"))
        sides = pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct()
        wanted = small_or_not(materialize(sides, "wanted"))
        found = materialize(texts.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("text").alias("text")), "pair-texts")
        salted = pairs.join(load.filter("salts > 1"), "u", "left").select(
            "u", "v", F.pmod(F.xxhash64("v"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt")
        )
        right = salted.join(found.select(F.col("node").alias("v"), F.col("text").alias("right")), "v")
        copies = (
            load.join(found.select(F.col("node").alias("u"), F.col("text").alias("left")), "u")
            .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
            .drop("salts")
        )
        return right.join(copies, ["u", "salt"]).select("u", "v", "left", "right").mapInArrow(run, "u long, v long")

    return verify


def _node(doc_id: Column, text: Column) -> Column:
    """The id, or for a null id a number behind all usual ids that is made from the text."""
    from_text = F.shiftrightunsigned(F.xxhash64(text), 2).bitwiseOR(F.lit(1 << 62))
    return F.coalesce(doc_id.cast("long"), from_text)


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row of (doc_id, text): doc_id, class_id, the least node of its class, and
    node and th (id and text hash of the row) and first (least node with the same text)."""
    keyed = docs.select("doc_id", "text", _node(F.col("doc_id"), F.col("text")).alias("node"))
    th = F.xxhash64("text").alias("th")
    has_words = F.col("text").rlike(r"[^\x20\x09-\x0D]")
    copy = F.when(has_words, F.md5("text")).otherwise(F.concat(F.lit("-"), F.col("node").cast("string")))
    rows = materialize(keyed.select("doc_id", "node", th, copy.alias("copy")), "documents")
    first = rows.groupBy("copy").agg(F.min("node").alias("first"))
    members = materialize(rows.join(first, "copy").select("doc_id", "node", "th", "first"), "members")
    signed = materialize(keyed.select("node", "text").mapInArrow(_sign, "node long, keys array<long>"), "signatures")
    reps = members.filter("node = first").select("node").distinct()
    buckets = signed.join(reps, "node", "left_semi").select(F.explode("keys").alias("key"), "node").distinct()
    texts = keyed.select("node", "text")
    labels = link_buckets(
        materialize(buckets, "buckets"),
        _verify(texts, threshold),
        open_per_row=OPEN_PER_ROW,
        central=True,
        sketch=_sketch(texts),
        alike=_alike(threshold),
    )
    named = members.join(labels.withColumnRenamed("node", "first"), "first", "left")
    return named.select("doc_id", F.coalesce("label", "first").alias("class_id"), "node", "th", "first")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their class, one for each class, with all columns."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    own = classes(rows).filter((F.col("node") == F.col("class_id")) & (F.col("node") == F.col("first")))
    stay = materialize(own.groupBy("node", "th").agg(F.count("*").alias("rows")), "kept-rows")
    once = stay.filter("rows = 1")
    # repeated rows of a kept document: any one of the equal rows stays
    again = small_or_not(materialize(stay.filter("rows > 1"), "repeated-rows"))
    node, th = _node(docs[id_col], docs[text_col]), F.xxhash64(docs[text_col])
    single = docs.join(once, (node == once["node"]) & (th == once["th"]), "left_semi")
    again = again.select(F.col("node").alias("_node"), F.col("th").alias("_th"))
    several = docs.join(again, (node == again["_node"]) & (th == again["_th"])).dropDuplicates(["_node", "_th"])
    return single.unionByName(several.drop("_node", "_th"))
