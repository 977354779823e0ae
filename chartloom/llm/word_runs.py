"""Stretches of words that repeat with a period, and texts without the repetitions.

Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0.  A run is a stretch of words
with smallest period q (words q apart are identical) that has at least
``max(LEAST_LENGTH, LEAST_EXPONENT * q)`` words and that no neighbouring word
extends with that period.

Runs are found by longest common extensions.  Ukkonen's algorithm builds the
suffix tree of the words and that of their reversal.  The Euler tour of a tree
gives the order of the suffixes and the depths at which it turns from one leaf
to the next; the least of these depths between two leaves is that of their
lowest common ancestor, which a table of minima over powers of two answers in
constant time.  The longest Lyndon words that start at each place, for the order
of the words and for its inverse, hold the root of every run; each is extended
both ways, and what reaches twice its length is a run.

A run of exponent LEAST_EXPONENT holds each of its words that many times.  Texts
are therefore first cut at words that are rarer than that within their piece,
over and over; what is left is mostly nothing, and trees are built of the rest.
No run is lost, and none reaches over a cut, since it would hold the rare word
as often as the others.  Trees take memory and time in proportion to the words
of such a piece, some 1 KB and 15 microseconds each.

A word is dropped from a text if some run holds it after that run's first q
words; the others are kept, joined by one space.  A null text has no words, and
counts as empty.  Whole texts are searched, however long.  Each row is searched
alone: repeated rows, and rows with null or repeated ids, give equal results.  An
id of any type is handed on; other columns are not read, whatever their names.
An empty table gives an empty one.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from chartloom.llm.common import text_slices

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
# Turns of cutting pieces at rare words; later ones would cut off little.
CUTS = 12

Run = tuple[int, int, int]  # start, length, period


class ExtensionTree:
    """Longest common prefixes of the suffixes of a sequence of numbers, 1 and up."""

    def __init__(self, sequence: list[int]):
        self.size = len(sequence)
        order, turns = _euler_tour(*_suffix_tree([*sequence, 0]), self.size + 1)
        self.rank = np.empty(self.size + 1, dtype=np.int64)
        self.rank[order] = np.arange(self.size + 1)
        self.minima = _minima(np.array(turns, dtype=np.int32))

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far the suffixes at ``a`` and ``b``, which differ, are equal."""
        x, y = self.rank[a], self.rank[b]
        low, high = np.minimum(x, y), np.maximum(x, y)  # turns low .. high - 1 lie between
        level = np.frexp(high - low)[1] - 1
        return np.minimum(self.minima[level, low], self.minima[level, high - (1 << level)])


def _suffix_tree(s: list[int]) -> tuple[int, dict[int, int], list[int], list[int]]:
    """Ukkonen's algorithm: the child at ``node * width + first number``, and the edge to each node as start and end."""
    size, width = len(s), max(s) + 1
    kids: dict[int, int] = {}
    start, stop, link = [0], [0], [0]
    node = edge = length = waiting = 0
    for place, number in enumerate(s):
        waiting += 1
        unlinked = 0
        while waiting:
            if not length:
                edge = place
            key = node * width + s[edge]
            below = kids.get(key)
            if below is None:
                kids[key] = len(start)
                start.append(place)
                stop.append(size)
                link.append(0)
                if unlinked:
                    link[unlinked] = node
                    unlinked = 0
            else:
                span = stop[below] - start[below]
                if length >= span:
                    node = below
                    edge += span
                    length -= span
                    continue
                middle = start[below] + length
                if s[middle] == number:
                    length += 1
                    if unlinked:
                        link[unlinked] = node
                    break
                split = len(start)
                kids[key] = split
                kids[split * width + s[middle]] = below
                kids[split * width + number] = split + 1
                start += (start[below], place)
                stop += (middle, size)
                link += (0, 0)
                start[below] = middle
                if unlinked:
                    link[unlinked] = split
                unlinked = split
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = place - waiting + 1
    return width, kids, start, stop


def _euler_tour(
    width: int, kids: dict[int, int], start: list[int], stop: list[int], size: int
) -> tuple[list[int], list[int]]:
    """Suffixes by leaf in ascending order, and the depth of the node between each two leaves."""
    keys = np.fromiter(kids.keys(), dtype=np.int64, count=len(kids))
    child = np.fromiter(kids.values(), dtype=np.int64, count=len(kids))
    node, number = np.divmod(keys, width)
    by_node = np.lexsort((-number, node))  # the last one is visited first
    begins = np.searchsorted(node[by_node], np.arange(len(start) + 1)).tolist()
    parents = np.zeros(len(start), dtype=np.int64)
    parents[child] = node
    below, parent = child[by_node].tolist(), parents.tolist()
    depth = [0] * len(start)
    order, turns = [], []
    open_nodes = below[begins[0] : begins[1]]
    turned = False
    while open_nodes:
        at = open_nodes.pop()
        above = depth[parent[at]]
        if turned:
            turns.append(above)
            turned = False
        depth[at] = above + stop[at] - start[at]
        if begins[at] < begins[at + 1]:
            open_nodes += below[begins[at] : begins[at + 1]]
        else:
            order.append(size - depth[at])
            turned = True
    return order, turns


def _minima(values: np.ndarray) -> np.ndarray:
    """Row k has the least of each 2 ** k consecutive values."""
    rows = [values]
    step = 1
    while 2 * step <= len(values):
        last = rows[-1]
        shorter = np.minimum(last[:-step], last[step:])
        rows.append(np.concatenate((shorter, last[len(last) - step :])))
        step *= 2
    return np.stack(rows)


def _lyndon_ends(rank: list[int]) -> tuple[list[int], list[int]]:
    """Where the longest Lyndon word at each place ends, for the order of the ranks and for its inverse.

    That is the next place of a lower, or of a higher, rank; the last rank is
    that of the empty suffix.  Without such a place the end is 0.
    """
    last = len(rank) - 1
    lower, higher = [0] * last, [0] * last
    for ends, sign in ((lower, 1), (higher, -1)):
        waiting: list[int] = []
        for place, value in enumerate(rank):
            while waiting and sign * rank[waiting[-1]] > sign * value:
                ends[waiting.pop()] = place
            if place < last:
                waiting.append(place)
    return lower, higher


def runs_of(sequence: list[int]) -> list[Run]:
    """The runs of a sequence of numbers, 1 and up, by start and then by period."""
    size = len(sequence)
    if size < LEAST_LENGTH:
        return []
    forward = ExtensionTree(sequence)
    lower, higher = _lyndon_ends(forward.rank.tolist())
    ends = np.array(lower + higher, dtype=np.int64)
    begin = np.tile(np.arange(size), 2)
    period = ends - begin
    root = (period > 0) & (ends < size) & (LEAST_EXPONENT * period <= size)
    begin, ends, period = begin[root], ends[root], period[root]
    after = forward.common(begin, ends)
    before = np.zeros(len(begin), dtype=np.int64)
    inner = np.flatnonzero(begin > 0)
    if len(inner):
        backward = ExtensionTree(sequence[::-1])
        before[inner] = backward.common(size - begin[inner], size - ends[inner])
    length = period + before + after
    long_enough = (length >= LEAST_EXPONENT * period) & (length >= LEAST_LENGTH)
    found = np.stack((begin - before, length, period), axis=1)[long_enough]
    return sorted(set(map(tuple, found.tolist())), key=lambda run: (run[0], run[2]))


def pieces(words: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """(place, words) of the pieces of a text that may hold runs."""
    waiting = [(0, words, 0)]
    while waiting:
        place, piece, turn = waiting.pop()
        times = Counter(piece)
        if turn == CUTS or min(times.values(), default=0) >= LEAST_EXPONENT:
            yield place, piece
        elif max(times.values(), default=0) >= LEAST_EXPONENT:
            cuts = [i for i, word in enumerate(piece) if times[word] < LEAST_EXPONENT]
            begin = 0
            for end in [*cuts, len(piece)]:
                if end - begin >= LEAST_LENGTH:
                    waiting.append((place + begin, piece[begin:end], turn + 1))
                begin = end + 1


def text_runs(words: list[bytes]) -> list[Run]:
    found = []
    for place, piece in pieces(words):
        number = {word: n for n, word in enumerate(dict.fromkeys(piece), 1)}
        found += [(place + start, length, period) for start, length, period in runs_of([number[w] for w in piece])]
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapse(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words that no run holds after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def find_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) per row of (doc_id, text).

    ``runs`` are structs of start, length and period, by start and then by
    period; ``collapsed`` is the text of the words that are kept.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    run_type = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            rows = []
            for text in texts:
                words = text.encode().split()  # at \x20 and \x09-\x0D
                runs = text_runs(words)
                named = [dict(zip(("start", "length", "period"), r)) for r in runs]
                rows.append((len(words), named, b" ".join(collapse(words, runs)).decode()))
            n_words, found, collapsed = (list(column) for column in zip(*rows))
            columns = [part["doc_id"], pa.array(n_words), pa.array(found, pa.list_(run_type)), pa.array(collapsed)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])

    schema = (
        f"doc_id {id_type}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    )
    return docs.select("doc_id", "text").mapInArrow(run, schema)
