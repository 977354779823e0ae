"""Token ids of words, kept by the hash of the word."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


class IdPool:
    """Ids of the words seen so far; forgets them all when there are too many.

    ``learn`` turns words into one array of ids and the number of ids of each.
    """

    def __init__(self, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], words_kept: int = 300_000):
        self.learn, self.words_kept = learn, words_kept
        self._clear()

    def _clear(self) -> None:
        # hashes in ascending order, and the number of each word
        self.known = np.zeros(0, dtype=np.uint64)
        self.number = np.zeros(0, dtype=np.int64)
        self.size = np.zeros(0, dtype=np.int64)
        self.begin = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def places(self, hashes: np.ndarray, word: Callable[[list[int]], list[str]]) -> np.ndarray:
        """Where the pool holds each hash; ``word`` gives the words at some places of ``hashes``."""
        if len(self.known) > self.words_kept:
            self._clear()
        at = np.searchsorted(self.known, hashes)
        places = np.full(len(hashes), -1, dtype=np.int64)
        inside = np.flatnonzero(at < len(self.known))
        inside = inside[self.known[at[inside]] == hashes[inside]]
        places[inside] = self.number[at[inside]]
        missing = np.flatnonzero(places < 0)
        if len(missing):
            ids, size = self.learn(word(missing.tolist()))
            n = len(self.size)
            places[missing] = np.arange(n, n + len(missing))
            order = missing[np.argsort(hashes[missing], kind="stable")]
            self.known = np.insert(self.known, at[order], hashes[order])
            self.number = np.insert(self.number, at[order], places[order])
            self.begin = np.concatenate((self.begin, len(self.ids) + np.cumsum(size) - size))
            self.size = np.concatenate((self.size, size))
            self.ids = np.concatenate((self.ids, ids))
        return places

    def gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all places in a row, and where those of each place end."""
        each = self.size[places]
        end = np.cumsum(each)
        total = int(end[-1]) if len(end) else 0
        return self.ids[np.repeat(self.begin[places] - (end - each), each) + np.arange(total)], end
