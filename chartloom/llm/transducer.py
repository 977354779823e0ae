"""Token counts by finite-state transducers compiled from a byte-level BPE file.

Two deterministic machines run in cascade.

The *splitter* reads character classes and marks where pre-tokens begin.  It
has twelve states.  A text batch is cut into chunks; each chunk is run from all
states at once, which gives its state map, and the maps of the chunks are
composed by a parallel prefix scan to find the state in which each begins.

The *counter* reads the bytes of pre-tokens.  Its transitions carry the number
of tokens that the byte adds to the encoding (negative where the byte lets
tokens merge).  A state is the set of places from which a token may still be
under way: for each its node in the token trie, the last token of the encoding
up to there, and the number of tokens relative to the present.  The encoding of
a prefix ends in the one token that is compatible with the last token before
it, that is, the pair encodes to itself.  There are finitely many such states;
they are compiled when first reached and kept in a bounded table.  A pre-token
resets the machine, so a chunk that begins at one has a constant state map and
chunk counts simply add up.

A pre-token of more than LONG bytes, such as a long run of random letters, would
have states of its own nearly everywhere; it is handed to the tokenizer library
itself.  Batches are counted SLICE bytes at a time, cut between pre-tokens, and
the table of states is emptied between slices when it holds MOST_STATES, so
neither long words nor long texts make it grow without bound.

Null and empty texts have no bytes and no tokens.  Whole texts are counted,
however long.  Rows are counted one by one: repeated rows and null or repeated
ids make no difference, and an id of any type is handed on.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from chartloom.llm.common import text_slices
from chartloom.llm.pretokens import BLANK, LETTER, NUMBER, classes
from chartloom.llm.spans import code_points

# Symbols of the splitter.
A, S, R, L, E, N, QUOTE, OTHER, SPACE, WHITE, STOP = range(11)
# Its states: what has been read of the present pre-token.
(BEGIN, LETTERS, NUMBERS, OTHERS, ONE_SPACE, ONE_WHITE, RUN_SPACE, RUN_WHITE, QUOTED, QUOTED_R, QUOTED_L, SHORTENED) = range(12)
STATES = 12
HERE, BEFORE = 1, 2  # a pre-token begins at this symbol, at the previous one
CHUNK = 128
MOST_STATES, MOST_PAIRS = 400_000, 300_000
LONG, SLICE = 4096, 1 << 21
OFFSET = 128  # of the counts in the packed transitions
FEW = 6


@cache
def symbols() -> np.ndarray:
    kind = classes()
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    table[kind == LETTER] = A
    table[kind == NUMBER] = N
    table[kind == BLANK] = WHITE
    for symbol, chars in ((S, "stmd"), (R, "rv"), (L, "l"), (E, "e"), (QUOTE, "'"), (SPACE, " ")):
        table[[ord(c) for c in chars]] = symbol
    return table


@cache
def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks for symbol * STATES + state."""
    letters, blanks = {A, S, R, L, E}, {SPACE, WHITE}
    fresh = {**dict.fromkeys(letters, LETTERS), N: NUMBERS, QUOTE: QUOTED, OTHER: OTHERS, SPACE: ONE_SPACE, WHITE: ONE_WHITE, STOP: BEGIN}
    joined = fresh | {QUOTE: OTHERS}  # behind a space an apostrophe starts no contraction
    more_blank = {SPACE: RUN_SPACE, WHITE: RUN_WHITE}

    def step(state: int, c: int) -> tuple[int, int]:
        if c == STOP:
            return BEGIN, HERE | (BEFORE if state in (QUOTED_R, QUOTED_L) else 0)
        if state == LETTERS and c in letters or state == NUMBERS and c == N or state == OTHERS and c in (OTHER, QUOTE):
            return state, 0
        if state in (ONE_SPACE, ONE_WHITE, RUN_SPACE, RUN_WHITE) and c in blanks:
            return more_blank[c], 0
        if state == ONE_SPACE:
            return joined[c], 0
        if state == RUN_SPACE:
            return joined[c], BEFORE
        if state == RUN_WHITE:
            return fresh[c], BEFORE | HERE
        if state == QUOTED and c in (S, R, L):
            return {S: SHORTENED, R: QUOTED_R, L: QUOTED_L}[c], 0
        if state == QUOTED and c in (OTHER, QUOTE):
            return OTHERS, 0
        if state == QUOTED_R and c == E or state == QUOTED_L and c == L:
            return SHORTENED, 0
        if state in (QUOTED_R, QUOTED_L):
            return (LETTERS, BEFORE) if c in letters else (fresh[c], BEFORE | HERE)
        return fresh[c], HERE

    steps = np.array([step(state, c) for c in range(STOP + 1) for state in range(STATES)], dtype=np.uint8)
    return steps[:, 0].copy(), steps[:, 1].copy()


def pre_token_starts(codes: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """True where a pre-token begins; ``stops`` lie between texts and count as one."""
    follow, mark = splitter()
    n = len(codes)
    rows = -(-n // CHUNK)
    read = np.full(rows * CHUNK, STOP, dtype=np.uint8)
    read[:n] = symbols()[codes]
    read[stops] = STOP
    # column t holds the t-th symbol of every chunk, scaled to index the tables
    by_step = np.ascontiguousarray(read.reshape(rows, CHUNK).T).astype(np.intp) * STATES
    maps = np.tile(np.arange(STATES, dtype=np.uint8), (rows, 1))
    for column in by_step:
        maps = follow[column[:, None] + maps]
    span = 1
    while span < rows:  # maps[i] becomes the map of chunks i - 2 * span + 1 .. i
        maps[span:] = np.take_along_axis(maps[span:], maps[:-span].astype(np.intp), axis=1)
        span *= 2
    state = np.concatenate(([BEGIN], maps[:-1, BEGIN]))
    marks = np.empty((CHUNK, rows), dtype=np.uint8)
    for t, column in enumerate(by_step):
        at = column + state
        marks[t], state = mark[at], follow[at]
    marks = marks.T.reshape(-1)[:n]
    starts = (marks & HERE) > 0
    starts[:-1] |= (marks[1:] & BEFORE) > 0
    return starts


def byte_alphabet() -> dict[str, int]:
    """The printable characters that stand for bytes in the vocabulary file."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Transitions:
    """A growing hash table from int32 keys to int32 values, searched for many keys at once."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.bits, self.used = 16, 0
        self.keys = np.full(1 << 16, -1, dtype=np.int32)
        self.values = np.full(1 << 16, -1, dtype=np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint32) * np.uint32(2654435769)) >> np.uint32(32 - self.bits)).astype(np.intp)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slots(keys)
        found = self.keys[slots]
        out = self.values[slots]
        missed = np.flatnonzero((found != keys) & (found >= 0))
        while len(missed):  # occupied by another key: look at the next slot
            slots[missed] = (slots[missed] + 1) & ((1 << self.bits) - 1)
            at = slots[missed]
            out[missed] = self.values[at]
            missed = missed[(self.keys[at] != keys[missed]) & (self.keys[at] >= 0)]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """``keys`` are distinct and not in the table."""
        if 3 * (self.used + len(keys)) > 1 << self.bits:
            old = self.keys >= 0
            keys, values = np.concatenate((self.keys[old], keys)), np.concatenate((self.values[old], values))
            while 3 * len(keys) > 1 << self.bits:
                self.bits += 1
            self.bits += 1
            self.used = 0
            self.keys = np.full(1 << self.bits, -1, dtype=np.int32)
            self.values = np.full(1 << self.bits, -1, dtype=np.int32)
        self.used += len(keys)
        slots = self._slots(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slots] < 0)
            _, first = np.unique(slots[free], return_index=True)  # one key for each free slot
            put = free[first]
            self.keys[slots[put]], self.values[slots[put]] = keys[put], values[put]
            stay = np.ones(len(keys), dtype=bool)
            stay[put] = False
            keys, values = keys[stay], values[stay]
            slots = (slots[stay] + 1) & ((1 << self.bits) - 1)


class Counter:
    """The counting machine of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        for token in spec["added_tokens"]:
            if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
                raise ValueError(f"unsupported added token {token['content']}")
        self.special = [token["content"] for token in spec["added_tokens"]]
        self.library = Tokenizer.from_file(path)
        letters = byte_alphabet()
        to_bytes = lambda s: bytes(letters[c] for c in s)
        self.rank = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.rank.setdefault((to_bytes(left), to_bytes(right)), rank)
        self.child: list[dict[int, int]] = [{}]
        self.ends: list[int] = [-1]  # the token that ends at a node
        self.tokens: list[bytes] = []
        for text in spec["model"]["vocab"]:
            if all(c in letters for c in text):
                self._add(to_bytes(text))
        self.fits: dict[int, bool] = {}
        self.compiled = Transitions()
        self._clear()

    def _add(self, token: bytes) -> None:
        node = 0
        for byte in token:
            if byte not in self.child[node]:
                self.child[node][byte] = len(self.child)
                self.child.append({})
                self.ends.append(-1)
            node = self.child[node][byte]
        self.ends[node] = len(self.tokens)
        self.tokens.append(token)

    def _clear(self) -> None:
        # a state: (node, last token or -1, tokens relative to now) of each place
        first = struct.pack("3i", 0, -1, 0)
        self.number = {first: 0}
        self.states = [first]
        self.compiled.clear()

    def encode(self, data: bytes) -> list[bytes]:
        """Merges applied in order of rank, the leftmost first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best, at = min((self.rank.get(pair, 1 << 60), i) for i, pair in enumerate(zip(parts, parts[1:])))
            if best == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _compatible(self, last: int, token: int) -> bool:
        if last < 0:
            return True
        key = last << 32 | token
        fits = self.fits.get(key)
        if fits is None:
            if len(self.fits) >= MOST_PAIRS:
                self.fits.clear()
            pair = [self.tokens[last], self.tokens[token]]
            fits = self.fits[key] = self.encode(pair[0] + pair[1]) == pair
        return fits

    def compile(self, key: int) -> int:
        """The transition of state * 256 + byte: next state * 256 + added tokens + OFFSET."""
        alive, ending = [], -1
        for node, last, count in struct.iter_unpack("3i", self.states[key >> 8]):
            node = self.child[node].get(key & 255)
            if node is None:
                continue
            alive.append((node, last, count))
            token = self.ends[node]
            if ending < 0 <= token and self._compatible(last, token):
                ending, added = token, count + 1
        if ending < 0:
            raise ValueError(f"byte {key & 255} is no token of its own")
        flat = [x for node, last, count in alive for x in (node, last, count - added)]
        after = struct.pack(f"{len(flat) + 3}i", *flat, 0, ending, 0)
        to = self.number.setdefault(after, len(self.states))
        if to == len(self.states):
            self.states.append(after)
        return to * 256 + added + OFFSET

    def follow(self, keys: np.ndarray) -> np.ndarray:
        """The transitions of many keys, compiled where they are new."""
        packed = self.compiled.find(keys)
        if packed.min() < 0:
            new = np.unique(keys[packed < 0])
            self.compiled.add(new, np.array([self.compile(key) for key in new.tolist()], dtype=np.int32))
            packed = self.compiled.find(keys)
        return packed

    def count(self, data: np.ndarray, starts: np.ndarray, forced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where chunks begin and their tokens; a chunk begins at each place in ``forced``."""
        edges = np.append(np.flatnonzero(starts), len(data))
        long = np.flatnonzero(np.diff(edges) > LONG)
        cuts = edges[np.searchsorted(edges, np.arange(SLICE, len(data), SLICE))]
        bounds = np.unique(np.concatenate(([0, len(data)], edges[long], edges[long + 1], cuts)))
        apart = set(edges[long].tolist())
        begins, counts = [], []
        for first, last in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if first in apart:
                text = data[first:last].tobytes().decode()
                begin, count = [first], [len(self.library.encode(text, add_special_tokens=False).ids)]
            else:
                inside = forced[np.searchsorted(forced, first) : np.searchsorted(forced, last)]
                begin, count = self._count(data[first:last], starts[first:last], inside - first)
                begin = begin + first
            begins.append(begin)
            counts.append(count)
        return np.concatenate(begins), np.concatenate(counts)

    def _count(self, data: np.ndarray, starts: np.ndarray, forced: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.states) > MOST_STATES:
            self._clear()
        edges = np.flatnonzero(starts)
        fresh = np.concatenate(([True], edges[1:] // CHUNK != edges[:-1] // CHUNK))
        begin = np.union1d(edges[fresh], forced)
        length = np.diff(np.append(begin, len(data)))
        order = np.argsort(-length, kind="stable")
        at, left = begin[order], length[order]
        state = np.zeros(len(at), dtype=np.int32)
        total = np.zeros(len(at), dtype=np.int64)
        lanes, step = len(at), 0
        while True:
            lanes = int(np.searchsorted(-left[:lanes], -step, side="left"))
            if lanes <= FEW:
                break
            place = at[:lanes] + step
            packed = self.follow(np.where(starts[place], 0, state[:lanes]) * 256 + data[place])
            state[:lanes] = packed >> 8
            total[:lanes] += (packed & 255) - OFFSET
            step += 1
        known: dict[int, int] = {}
        for lane in range(lanes):  # a few long pre-tokens
            here, added = int(state[lane]), 0
            first, last = int(at[lane]) + step, int(at[lane] + left[lane])
            for byte, new in zip(data[first:last].tolist(), starts[first:last].tolist()):
                key = (0 if new else here) * 256 + byte
                packed = known.get(key)
                if packed is None:
                    packed = known[key] = int(self.follow(np.array([key], dtype=np.int32))[0])
                here = packed >> 8
                added += (packed & 255) - OFFSET
            total[lane] += added
        counts = np.empty(len(at), dtype=np.int64)
        counts[order] = total
        return begin, counts


@cache
def counter(path: str) -> Counter:
    return Counter(path)


def count_texts(texts: list[str], machine: Counter) -> np.ndarray:
    """Tokens of each text; a special string counts as one token and splits its text."""
    pieces, owner = [], []
    special = np.zeros(len(texts), dtype=np.int64)
    for i, text in enumerate(texts):
        parts = [text]
        for mark in machine.special:
            parts = [p for part in parts for p in part.split(mark)] if mark in text else parts
        special[i] = len(parts) - 1
        pieces += parts
        owner += [i] * len(parts)
    codes, begins = code_points(pieces)
    stops = begins[1:] - 1
    starts = pre_token_starts(codes, stops)
    # from characters to bytes; stops are left out
    width = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
    width[stops] = 0
    offset = np.cumsum(width) - width
    data = np.frombuffer("".join(pieces).encode(), dtype=np.uint8)
    starts[stops] = False
    flags = np.zeros(len(data), dtype=bool)
    flags[offset[starts]] = True
    piece_bytes = np.append(offset, len(data))[begins]
    out = special
    if len(data):
        begin, counts = machine.count(data, flags, piece_bytes[:-1][np.diff(piece_bytes) > 0])
        first = np.searchsorted(begin, piece_bytes)
        sums = np.concatenate(([0], np.cumsum(counts)))
        np.add.at(out, owner, sums[first[1:]] - sums[first[:-1]])
    return out


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per row of (doc_id, text): doc_id, n_bytes and n_tokens."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = counter(vocabulary)
        for part, texts in text_slices(batches):
            sizes = [len(t.encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [part["doc_id"], pa.array(sizes, pa.int64()), pa.array(count_texts(texts, machine), pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, n_bytes long, n_tokens long")
