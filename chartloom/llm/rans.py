"""Range asymmetric numeral coding of token ids in interleaved lanes.

One frequency table, shared by all blocks, sums to 2 ** PRECISION.  Lane k of a
block codes the ids k, k + lanes, k + 2 * lanes ...; all lanes take each step
together as one numpy operation.  A frame holds everything a decoder needs but
the shared table:

    magic "RNS1" | ids | lanes | steps between checkpoints | checkpoints |
    words | crc32 of all that follows                        (7 x uint32)
    checkpoint: place in the words, then the state of each lane   (uint64)
    words                                                         (uint32)

A checkpoint holds the states before its step, so any stretch between two
checkpoints can be decoded alone; the first one is the start.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

PRECISION = 20
TOTAL = 1 << PRECISION
LOW = np.uint64(1 << 31)
MOST_LANES, CHECKPOINT_STEPS = 1024, 256
HEAD = struct.Struct("<4s6I")
MAGIC = b"RNS1"
SHIFT, WORD = np.uint64(PRECISION), np.uint64(32)
LIMIT = np.uint64(31 - PRECISION + 32)


def shared_table(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to TOTAL; every id that occurs has at least one."""
    counts = np.asarray(counts, dtype=np.float64)
    seen = counts > 0
    if not seen.any():
        return np.zeros(len(counts), dtype=np.uint64)
    if seen.sum() > TOTAL:
        raise ValueError("more symbols than the precision can hold")
    freq = np.where(seen, np.maximum(1, np.floor(counts * (TOTAL / counts.sum()))), 0).astype(np.int64)
    over = int(freq.sum()) - TOTAL
    if over <= 0:
        freq[np.argmax(freq)] -= over
    else:  # rare ids were raised to one: take it back from the frequent ones
        for i in np.argsort(-freq, kind="stable"):
            take = min(over, int(freq[i]) // 2)
            freq[i] -= take
            over -= take
            if not over:
                break
    return freq.astype(np.uint64)


class Codec:
    def __init__(self, freq: np.ndarray):
        self.freq = freq
        self.cum = np.cumsum(freq) - freq
        self.symbol = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))

    def encode(self, ids: np.ndarray) -> bytes:
        n = len(ids)
        lanes = min(MOST_LANES, 1 << max(0, (n // 64).bit_length() - 1))
        steps = -(-n // lanes)
        freq, cum = self.freq[ids], self.cum[ids]
        if n and not freq.all():
            raise ValueError("an id is not in the shared table")
        limit = freq << LIMIT
        state = np.full(lanes, LOW, dtype=np.uint64)
        words, marks = [np.zeros(0, np.uint32)] * steps, {}
        for t in range(steps - 1, -1, -1):
            a, b = t * lanes, min(n, (t + 1) * lanes)
            x, f = state[: b - a], freq[a:b]
            full = x >= limit[a:b]
            words[t] = x[full].astype(np.uint32)
            x = np.where(full, x >> WORD, x)
            q = x // f
            state[: b - a] = (q << SHIFT) + (x - q * f) + cum[a:b]
            if t % CHECKPOINT_STEPS == 0:
                marks[t] = state.copy()
        place = np.cumsum([0, *map(len, words)])
        body = b"".join(
            [
                *(struct.pack("<Q", place[t]) + marks[t].astype("<u8").tobytes() for t in sorted(marks)),
                np.concatenate([*words, np.zeros(0, np.uint32)]).astype("<u4").tobytes(),
            ]
        )
        return HEAD.pack(MAGIC, n, lanes, CHECKPOINT_STEPS, len(marks), int(place[-1]), zlib.crc32(body)) + body

    def decode(self, frame: bytes, stretch: int | None = None) -> np.ndarray:
        """All ids of a frame, or those of one stretch between checkpoints."""
        magic, n, lanes, every, marks, n_words, crc = HEAD.unpack_from(frame)
        body = memoryview(frame)[HEAD.size :]
        if magic != MAGIC or zlib.crc32(body) != crc:
            raise ValueError("damaged frame")
        words = np.frombuffer(body, "<u4", n_words, marks * 8 * (lanes + 1)).astype(np.uint64)
        first, last = (0, -(-n // lanes)) if stretch is None else (stretch * every, min(-(-n // lanes), (stretch + 1) * every))
        out = np.empty(max(0, min(n, last * lanes) - first * lanes), dtype=np.uint32)
        if not len(out):
            return out
        mark = np.frombuffer(body, "<u8", lanes + 1, (first // every) * 8 * (lanes + 1))
        at, state = int(mark[0]), mark[1:].astype(np.uint64)
        for t in range(first, last):
            a, b = t * lanes, min(n, (t + 1) * lanes)
            x = state[: b - a]
            slot = x & np.uint64(TOTAL - 1)
            ids = self.symbol[slot]
            out[a - first * lanes : b - first * lanes] = ids
            x = self.freq[ids] * (x >> SHIFT) + slot - self.cum[ids]
            low = np.flatnonzero(x < LOW)
            x[low] = (x[low] << WORD) | words[at : at + len(low)]
            at += len(low)
            state[: b - a] = x
        return out


def stretches(frame: bytes) -> int:
    """How many stretches of a frame can be decoded alone."""
    return HEAD.unpack_from(frame)[4]
