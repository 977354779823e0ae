"""Character classes and the pre-token boundaries of the two vocabularies."""

from __future__ import annotations

from functools import cache

import numpy as np
import tiktoken

OTHER, LETTER, NUMBER, BLANK, BREAK = range(5)
APOSTROPHE, SPACE = 39, 32
# Code points that the library is asked about at a time.
PLANE_PART = 1 << 13
# The characters with the property White_Space.
WHITE_SPACE = [
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
# What may follow an apostrophe to form a pre-token with it.
CONTRACTIONS = ["s", "t", "re", "ve", "m", "ll", "d"]


def _matches(pattern: str) -> np.ndarray:
    """The code points that a pattern of the tokenizer library matches.

    Libraries follow a Unicode version of their own, so the library is asked: with
    bytes as its tokens it keeps what the pattern matches and drops the rest.
    """
    library = tiktoken.Encoding(
        "classes", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={}
    )
    found = []
    # a list of all ids at once would take some 100 MB of every worker
    for begin in range(0, 0x110000, PLANE_PART):
        some = "".join(chr(c) for c in range(begin, begin + PLANE_PART) if not 0xD800 <= c < 0xE000)
        found.append(np.frombuffer(bytes(library.encode_ordinary(some)).decode().encode("utf-32-le"), dtype=np.uint32))
    return np.concatenate(found)


@cache
def classes() -> np.ndarray:
    """The class of each code point, as the tokenizer libraries have it."""
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    table[_matches(r"\p{L}")] = LETTER
    table[_matches(r"\p{N}")] = NUMBER
    table[WHITE_SPACE] = BLANK
    return table


def _contraction_ends(codes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the apostrophes at ``at``: those that begin a contraction, and its end."""
    padded = np.concatenate((codes, np.zeros(3, codes.dtype)))
    length = np.zeros(len(at), dtype=np.int64)
    for tail in CONTRACTIONS:
        fits = np.ones(len(at), dtype=bool)
        for k, letter in enumerate(tail):
            fits &= padded[at + 1 + k] == ord(letter)
        length[fits] = 1 + len(tail)
    return at[length > 0], (at + length)[length > 0]


def byte_level_starts(codes: np.ndarray, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pre-tokens of the byte-level pattern start, and the class at each start.

    ``breaks`` are the places of separators between texts, which become
    segments of class BREAK.
    """
    kind = classes()[codes]
    kind[breaks] = BREAK
    start = np.ones(len(codes), dtype=bool)
    start[1:] = kind[1:] != kind[:-1]
    # a run of white space gives its last character to what follows it
    last = np.flatnonzero((kind[:-1] == BLANK) & (kind[1:] != BLANK) & (kind[1:] != BREAK))
    start[last] = True
    start[last[codes[last] == SPACE] + 1] = False
    quote = np.flatnonzero((codes == APOSTROPHE) & start)
    begin, end = _contraction_ends(codes, quote)
    start[begin + 1] = False
    start[end] = True
    at = np.flatnonzero(start)
    return at, kind[at]


def word_starts(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for the word pattern: single digits, and blanks as segments to drop."""
    kind = classes()[codes]
    start = np.ones(len(codes), dtype=bool)
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == NUMBER)
    quote = np.flatnonzero((codes == APOSTROPHE) & start)
    begin, end = _contraction_ends(codes, quote)
    start[begin + 1] = False
    start[end] = True
    at = np.flatnonzero(start)
    return at, kind[at]
