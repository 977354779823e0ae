"""Byte-level BPE encoding and decoding by a global shuffle of distinct words.

1. Texts are cut into blocks.  In each block the pre-tokens are listed with
   their positions: the distinct words once, and for each position which of
   them stands there.
2. The words of all blocks are dealt to buckets by a hash of the word, so each
   distinct word meets all its listings in one task, is encoded once, and its
   ids go back to the blocks that list it.
3. Each block puts the ids in the order of its positions and cuts them into
   documents.

A word costs one listing per block, not per occurrence, so neither the most
frequent word nor a hot source makes a large group; listings travel packed and
compressed.  Decoding looks ids up in the token-byte table, whose size is the
vocabulary's.

Null texts are empty and give no ids.  Repeated rows and null ids pass through.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import materialize, text_slices
from chartloom.llm.pretokens import BREAK, byte_level_starts
from chartloom.llm.spans import code_points, hash_spans

BLOCK_CHARS = 2 << 20
# Documents that are decoded at a time.
DECODED_AT_ONCE = 500
WORDS_KEPT = 2_000_000
POSITIONS = -1
LISTING = "block long, bucket int, payload binary, ids array<long>, counts array<int>"


@cache
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


@cache
def word_encoder(path: str):
    """Encodes one pre-token: the pattern takes whatever it is given as a whole."""
    return tiktoken.Encoding("words", pat_str=r"[\s\S]+", mergeable_ranks=read_ranks(path), special_tokens={})


def squeeze(values: np.ndarray) -> bytes:
    """Compressed uint32 values, byte by byte of significance."""
    return zstandard.compress(np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 3)


def expand(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def pack(parts: list[bytes]) -> bytes:
    sizes = np.fromiter(map(len, parts), dtype="<u4", count=len(parts))
    return zstandard.compress(len(parts).to_bytes(4, "little") + sizes.tobytes() + b"".join(parts), 1)


def unpack(data: bytes) -> list[bytes]:
    plain = zstandard.decompress(data)
    n = int.from_bytes(plain[:4], "little")
    ends = 4 + 4 * n + np.cumsum(np.frombuffer(plain, "<u4", n, 4), dtype=np.int64)
    begins = np.concatenate(([4 + 4 * n], ends[:-1])) if n else ends
    return [plain[a:b] for a, b in zip(begins.tolist(), ends.tolist())]


def list_words(texts: list[str], buckets: int):
    """Distinct words by bucket, the word number at each position, positions per text."""
    codes, begins = code_points(texts)
    at, kind = byte_level_starts(codes, begins[1:] - 1)
    ends = np.append(at[1:], len(codes))
    at, ends = at[kind != BREAK], ends[kind != BREAK]
    counts = np.diff(np.searchsorted(at, begins))
    found, example, number = np.unique(hash_spans(codes, at, ends), return_index=True, return_inverse=True)
    bucket = (found % np.uint64(buckets)).astype(np.int64)
    joined = "\n".join([*texts, ""])
    spelled = [joined[a:b].encode() for a, b in zip(at[example].tolist(), ends[example].tolist())]
    # in order of spelling within a bucket, neighbours compress well
    order = np.array(sorted(range(len(spelled)), key=lambda i: (bucket[i], spelled[i])), dtype=np.int64)
    place = np.empty(len(order), dtype="<u4")
    place[order] = np.arange(len(order))
    words = [spelled[i] for i in order.tolist()]
    edges = np.searchsorted(bucket[order], np.arange(buckets + 1))
    lists = [(b, words[edges[b] : edges[b + 1]]) for b in np.flatnonzero(np.diff(edges)).tolist()]
    return lists, place[number], counts


def _list_blocks(buckets: int, positions_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 40
        for part, texts in text_slices(batches, chars=BLOCK_CHARS):
            lists, positions, counts = list_words(texts, buckets)
            if positions_only:
                rows, ids, sizes = [(POSITIONS, squeeze(positions))], [part["doc_id"].to_pylist()], [counts.tolist()]
            else:
                rows = [(bucket, pack(words)) for bucket, words in lists]
                ids = sizes = [None] * len(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block] * len(rows), pa.int64()),
                    pa.array([bucket for bucket, _ in rows], pa.int32()),
                    pa.array([payload for _, payload in rows], pa.binary()),
                    pa.array(ids, pa.list_(pa.int64())),
                    pa.array(sizes, pa.list_(pa.int32())),
                ],
                names=["block", "bucket", "payload", "ids", "counts"],
            )
            block += 1

    return run


def _encode_listings(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, known = word_encoder(vocabulary), {}
        for batch in batches:
            out = []
            for data in batch["payload"].to_pylist():
                coded = []
                for word in unpack(data):
                    ids = known.get(word)
                    if ids is None:
                        if len(known) >= WORDS_KEPT:
                            known.clear()
                        ids = known[word] = np.array(encoder.encode_ordinary(word.decode()), dtype="<u4").tobytes()
                    coded.append(ids)
                out.append(pack(coded))
            none = pa.nulls(batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["block"],
                    batch["bucket"],
                    pa.array(out, pa.binary()),
                    none.cast(pa.list_(pa.int64())),
                    none.cast(pa.list_(pa.int32())),
                ],
                names=["block", "bucket", "payload", "ids", "counts"],
            )

    return run


def _reassemble(block: pa.Table) -> pa.Table:
    """All rows of one block: its positions and the ids of its words."""
    block = block.sort_by("bucket")
    if block["bucket"][0].as_py() != POSITIONS:
        raise ValueError("a block has no positions: the documents changed between two reads")
    positions = expand(block["payload"][0].as_py())
    words = [w for data in block["payload"].to_pylist()[1:] for w in unpack(data)]
    if len(words) != (int(positions.max()) + 1 if len(positions) else 0):
        raise ValueError("words and positions of a block do not match: the documents changed between two reads")
    size = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) // 4
    pool = np.frombuffer(b"".join(words), dtype="<u4")
    begin = np.cumsum(size) - size
    each = size[positions]
    end = np.cumsum(each)
    ids = pool[np.repeat(begin[positions] - (end - each), each) + np.arange(end[-1] if len(end) else 0)]
    edges = np.concatenate(([0], end))[np.concatenate(([0], np.cumsum(block["counts"][0].as_py())))]
    return pa.table(
        {
            "doc_id": pa.array(block["ids"][0].as_py(), pa.int64()),
            "ids": pa.array([ids[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary()),
        }
    )


def encode(docs: DataFrame, vocabulary: str, written: bool = False) -> DataFrame:
    """Per row of (doc_id, text): doc_id and its ids as little-endian unsigned 32-bit integers.

    The documents are read twice, for words and for positions, which must find
    the same rows in the same partitions.  Say ``written`` if ``docs`` only
    selects columns of a written table; anything else is written first.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    docs = docs if written else materialize(docs, "texts")
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    coded = (
        docs.mapInArrow(_list_blocks(buckets, False), LISTING)
        .select("block", "bucket", "payload")
        .repartition(buckets, "bucket")
        .mapInArrow(_encode_listings(vocabulary), LISTING)
    )
    positions = docs.mapInArrow(_list_blocks(buckets, True), LISTING)
    return positions.unionByName(coded).groupBy("block").applyInArrow(_reassemble, "doc_id long, ids binary")


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Adds ``decoded``, the bytes of the ids, to (doc_id, ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = dict(zip(read_ranks(vocabulary).values(), read_ranks(vocabulary))).__getitem__
        for batch in (b.slice(i, DECODED_AT_ONCE) for b in batches for i in range(0, b.num_rows, DECODED_AT_ONCE)):
            texts = [b"".join(map(token, np.frombuffer(ids, "<u4").tolist())) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["ids"], pa.array(texts, pa.binary())], names=["doc_id", "ids", "decoded"]
            )

    return encoded.mapInArrow(run, "doc_id long, ids binary, decoded binary")
