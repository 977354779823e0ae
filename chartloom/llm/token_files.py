"""Token ids of a corpus in compressed files, in ascending order of doc_id.

The ids are written once, to count them for the shared frequency table, and
then sent to the files.  A file is a range of doc_id; within it documents lie in
order, in frames of whole documents that are coded independently (see
:mod:`chartloom.llm.rans`).  Files are rows of a Parquet table, one per frame,
as Spark itself writes and reads them on any store and drops what failed tasks
leave.

Ids of equal pre-tokens are looked up; only pre-tokens not seen before go
through the library.  Texts with characters outside the plain range, where
normalisation can depend on the context, go through the library as a whole.

Null texts are empty: such documents hold the end id alone.  A null doc_id
comes first; rows with one doc_id lie in the order of the hash of their text.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from chartloom.llm.common import materialize, text_slices
from chartloom.llm.id_pool import IdPool
from chartloom.llm.pretokens import BLANK, classes, word_starts
from chartloom.llm.rans import Codec, shared_table
from chartloom.llm.spans import code_points, hash_spans

FILE_IDS, FRAME_IDS = 4 << 20, 1 << 18
MOST_FILES = 4096
NULL_FIRST = -(2**63)
# Blocks whose letters are the same in every Unicode version.
PLAIN_BLOCKS = [(0x20, 0x7F), (0xA1, 0x250), (0x370, 0x3FF), (0x400, 0x482), (0x48A, 0x500), (0x2010, 0x2028), (0x4E00, 0x9FA6)]


@cache
def lower_table() -> np.ndarray:
    """The lower case of each code point outside the odd ones."""
    table = np.arange(0x110000, dtype=np.uint32)
    plain = np.flatnonzero(~odd_characters())
    table[plain] = [ord(chr(c).lower()) for c in plain.tolist()]
    return table


@cache
def odd_characters() -> np.ndarray:
    """True for code points whose text the library must see as a whole."""
    odd = np.ones(0x110000, dtype=bool)
    for first, last in PLAIN_BLOCKS:
        for c in range(first, last):
            ch = chr(c)
            low = ch.lower()
            odd[c] = not (
                unicodedata.normalize("NFC", ch) == ch
                and unicodedata.normalize("NFC", low) == low
                and len(low) == 1
                and unicodedata.category(ch)[0] in "LNPSZ"
                and unicodedata.category(ch)[0] == unicodedata.category(low)[0]
            )
    odd[[9, 10, 13]] = False
    odd[0x3A3] = True  # its lower case depends on what follows
    return odd


class WordCoder:
    """Ids of whole texts by looking up pre-tokens."""

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.suffix = spec["model"]["end_of_word_suffix"]
        if not self.suffix:
            raise ValueError("the vocabulary does not mark the ends of words")
        self.special = [t["content"] for t in spec["added_tokens"]]
        byte_level = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        spec |= {
            "normalizer": None,
            "added_tokens": [],
            "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, byte_level]},
        }
        self.words = Tokenizer.from_str(json.dumps(spec))
        self.vocabulary = self.whole.get_vocab_size()
        self.ends = np.zeros(self.vocabulary, dtype=bool)
        self.ends[[i for token, i in self.words.get_vocab().items() if token.endswith(self.suffix)]] = True
        self.pool = IdPool(self._learn)

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # fast: without offsets in the text
        (found,) = self.words.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(found.ids, dtype=np.uint32)
        last = np.flatnonzero(self.ends[ids])
        if len(last) != len(words):
            raise ValueError("the library did not end each word with a marked token")
        return ids, np.diff(np.concatenate(([-1], last)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and where each text's ids begin and end."""
        codes, begins = code_points(texts)
        # the separators between texts are blanks, which the pattern drops
        odd = np.add.reduceat(odd_characters()[codes], begins[:-1]) > 0 if texts else np.zeros(0, bool)
        for i, text in enumerate(texts):
            odd[i] |= any(mark in text for mark in self.special)
        odd_ids = {i: np.array(self.whole.encode(texts[i], add_special_tokens=False).ids, np.uint32) for i in np.flatnonzero(odd)}
        if odd_ids:
            texts = ["" if odd[i] else t for i, t in enumerate(texts)]
            codes, begins = code_points(texts)
        codes = lower_table()[codes]
        at, kind = word_starts(codes)
        end = np.append(at[1:], len(codes))
        at, end = at[kind != BLANK], end[kind != BLANK]
        first = np.searchsorted(at, begins)
        found, example, number = np.unique(hash_spans(codes, at, end), return_index=True, return_inverse=True)

        def words(places: list[int]) -> list[str]:
            joined = "\n".join([*texts, ""])
            spans = zip(at[example[places]].tolist(), end[example[places]].tolist())
            return [joined[a:b].lower() for a, b in spans]

        ids, stop = self.pool.gather(self.pool.places(found, words)[number])
        edges = np.concatenate(([0], stop))[first]
        if odd_ids:
            parts = [odd_ids.get(i, ids[edges[i] : edges[i + 1]]) for i in range(len(texts))]
            ids = np.concatenate(parts)
            edges = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        return ids, edges


@cache
def word_coder(path: str) -> WordCoder:
    return WordCoder(path)


IDS = "ord long, doc_id long, th long, n long, ids binary"


def tokenize(docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """The ids of each (ord, doc_id, th, text) and the end id, two bytes each if they fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = word_coder(vocabulary)
        kind = id_type(coder.vocabulary)
        for part, texts in text_slices(batches):
            ids, edges = coder.encode(texts)
            data = [np.append(ids[a:b], end_id).astype(kind).tobytes() for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [part["ord"], part["doc_id"], part["th"], pa.array(np.diff(edges) + 1), pa.array(data, pa.binary())],
                names=["ord", "doc_id", "th", "n", "ids"],
            )

    return docs.mapInArrow(run, IDS)


def id_type(vocabulary_size: int) -> str:
    return "<u2" if vocabulary_size <= 1 << 16 else "<u4"


def count_ids(tokenized: DataFrame, size: int) -> np.ndarray:
    """How often each id occurs in all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for data in batch["ids"].to_pylist():
                seen += np.bincount(np.frombuffer(data, id_type(size)), minlength=size) if len(data) > size else 0
            short = b"".join(data for data in batch["ids"].to_pylist() if len(data) <= size)
            seen += np.bincount(np.frombuffer(short, id_type(size)), minlength=size)
        ids = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(seen[ids])], names=["id", "n"])

    counts = tokenized.select("ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    out = np.zeros(size, dtype=np.int64)
    for row in counts.toLocalIterator():  # as many rows as the vocabulary has ids
        out[row["id"]] = row["n"]
    return out


def _assign_files(bounds: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            file = np.searchsorted(bounds, batch["ord"].to_numpy(), side="left").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(file), *batch.columns], names=["file", *batch.schema.names])

    return run


FRAMES = "file int, frame int, first long, doc_ids array<long>, n_tokens array<int>, payload binary"


def _write_frames(freq: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(freq)
        kind = id_type(len(freq))
        file = frame = first = None
        held: list[np.ndarray] = []
        names: list[int | None] = []
        n_held = 0

        def flush():
            nonlocal frame, first, held, names, n_held
            sizes = [len(h) for h in held]
            row = pa.RecordBatch.from_arrays(
                [
                    pa.array([file], pa.int32()),
                    pa.array([frame], pa.int32()),
                    pa.array([first], pa.int64()),
                    pa.array([names], pa.list_(pa.int64())),
                    pa.array([sizes], pa.list_(pa.int32())),
                    pa.array([codec.encode(np.concatenate(held))], pa.binary()),
                ],
                names=["file", "frame", "first", "doc_ids", "n_tokens", "payload"],
            )
            frame, first, held, names, n_held = frame + 1, first + n_held, [], [], 0
            return row

        for batch in batches:
            for f, name, data in zip(*(batch[c].to_pylist() for c in ("file", "doc_id", "ids"))):
                ids = np.frombuffer(data, kind).astype(np.uint32)
                if held and (f != file or n_held + len(ids) > FRAME_IDS):
                    yield flush()
                if f != file:
                    file, frame, first = f, 0, 0
                held.append(ids)
                n_held += len(ids)
                names.append(name)
        if held:
            yield flush()

    return run


def write_corpus(docs: DataFrame, path: str, vocabulary: str, end_id: int) -> None:
    """Write the ids of (doc_id, text) as frames, and the table they share, under ``path``.

    doc_id is an integer.  Below ``path``: frames and table.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_FIRST)).alias("ord"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("th"),
        "text",
    )
    tokenized = materialize(tokenize(keyed, vocabulary, end_id), "token-ids")
    counts = count_ids(tokenized, word_coder(vocabulary).vocabulary)
    freq = shared_table(counts)
    files = int(min(MOST_FILES, max(1, -(-int(counts.sum()) // FILE_IDS))))
    cuts = [k / files for k in range(1, files)]
    bounds = tokenized.agg(F.percentile_approx("ord", cuts, 100 * files)).first()[0] if cuts else []
    (
        tokenized.mapInArrow(_assign_files(sorted(bounds or [])), "file int, " + IDS)
        .repartition(files, "file")
        .sortWithinPartitions("file", "ord", "th")
        .select("file", "doc_id", "ids")
        .mapInArrow(_write_frames(freq), FRAMES)
        .write.parquet(f"{path}/frames")
    )
    rows = [(int(i), int(freq[i])) for i in np.flatnonzero(freq)]
    table = spark.createDataFrame(rows, "id int, freq long")
    table.withColumn("ids", F.lit(len(freq))).coalesce(1).write.parquet(f"{path}/table")


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it) and ids (uint32)."""
    frames = spark.read.parquet(f"{path}/frames")
    rows = spark.read.parquet(f"{path}/table").collect()  # bounded by the vocabulary
    freq = np.zeros(rows[0]["ids"] if rows else 1, dtype=np.uint64)
    for row in rows:
        freq[row["id"]] = row["freq"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(freq)
        for batch in batches:
            for row in batch.to_pylist():
                ids = codec.decode(row["payload"]).astype("<u4")
                ends = np.cumsum(row["n_tokens"])
                begins = ends - row["n_tokens"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["file"]] * len(ends), pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["first"] + begins, pa.int64()),
                        pa.array([ids[a:b].tobytes() for a, b in zip(begins, ends)], pa.binary()),
                    ],
                    names=["file", "doc_id", "place", "ids"],
                )

    # at most MOST_FILES rows
    totals = frames.groupBy("file").agg(F.sum(F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, n: a + n)).alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    base = F.broadcast(totals.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")))
    return (
        frames.mapInArrow(run, "file int, doc_id long, place long, ids binary")
        .join(base, "file")
        .select("doc_id", (F.col("base") + F.col("place")).alias("start"), "ids")
    )


