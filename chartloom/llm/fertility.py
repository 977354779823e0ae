"""Quality rules by tokeniser fertility.

A public vocabulary with byte fallback measures each text: characters per
token, share of tokens that are single fallback bytes, and entropy of its token
distribution in bits.  Text of a language the vocabulary knows keeps to a
narrow band of each; noise, binary data and boilerplate do not.

The bands belong to the script that most letters of a text have.  They are
taken from the measures of all documents that pass the base rules: the median,
and MARGIN times the distance from it to the 5th or 95th percentile, but never
closer to the median than the factor SLACK.  No band is wider than DEFAULT,
however much of the input is noise.  The fewer documents a script has, the
closer its bands lie to DEFAULT: they are the mean of both, weighted by the
number of documents and by PRIOR.

Percentiles are exact over measures cut to GRID cells per unit: documents are
counted per cell, of which there is a bounded number, and the cells are walked
in order.  Limits depend on the documents alone, not on partitions or order.

Null and empty texts have no words and fail the base rules, as does any text of
under 50 words.  Rows are judged one by one; repeated rows get equal verdicts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.llm.common import materialize, small_or_not, text_slices
from chartloom.llm.id_pool import IdPool
from chartloom.llm.pretokens import LETTER, classes
from chartloom.llm.spans import BASE, code_points, hash_spans, mix, word_spans

LEAST_WORDS, MOST_REPEATED = 50, 50
MARGIN, SLACK, PRIOR = 6.0, 0.6, 30
GRID = 1000
LEAST_SHARE = 0.05
DEFAULT = {"cpt_low": 0.5, "cpt_high": 15.0, "share_high": 0.5, "entropy_low": 1.0}
# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
# Code point ranges of the larger scripts.
SCRIPTS = {
    "latin": [(0x41, 0x250), (0x1E00, 0x1F00)],
    "greek": [(0x370, 0x400), (0x1F00, 0x2000)],
    "cyrillic": [(0x400, 0x530)],
    "armenian": [(0x530, 0x590)],
    "hebrew": [(0x590, 0x600)],
    "arabic": [(0x600, 0x700), (0x750, 0x780), (0xFB50, 0xFE00)],
    "devanagari": [(0x900, 0x980)],
    "bengali": [(0x980, 0xA00)],
    "tamil": [(0xB80, 0xC00)],
    "thai": [(0xE00, 0xE80)],
    "georgian": [(0x10A0, 0x1100)],
    "hangul": [(0x1100, 0x1200), (0xAC00, 0xD7B0)],
    "kana": [(0x3040, 0x3100)],
    "han": [(0x3400, 0x4DC0), (0x4E00, 0xA000), (0x20000, 0x32000)],
}
NAMES = ["none", "other", *SCRIPTS]
MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_tokens long, script string, chars_per_token double, byte_share double, entropy double"
)


@cache
def script_table() -> np.ndarray:
    """The number of the script of each letter, 0 for what is no letter."""
    table = np.ones(0x110000, dtype=np.uint8)
    for number, ranges in enumerate(SCRIPTS.values(), 2):
        for first, end in ranges:
            table[first:end] = number
    table[classes() != LETTER] = 0
    return table


class Pieces:
    """Token ids of white-space words in a sentencepiece model."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        self.is_byte = np.array([self.model.is_byte(i) for i in range(self.size)])
        self.pool = IdPool(self._learn)

    def _learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        coded = self.model.encode(words, num_threads=1)
        size = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
        return np.array([i for ids in coded for i in ids], dtype=np.uint32), size


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def _per_text(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Sums of an array between consecutive edges."""
    sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return sums[edges[1:]] - sums[edges[:-1]]


def repeated_words(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text: words inside a run of three that its text holds twice or more."""
    covered = np.zeros(len(words), dtype=bool)
    if len(words) > 2:
        row = np.searchsorted(first, np.arange(len(words) - 2), side="right") - 1
        inside = np.flatnonzero(np.arange(len(words) - 2) + 2 < first[row + 1])
        triple = mix(mix(words[inside] * BASE + words[inside + 1]) * BASE + words[inside + 2])
        key = mix(triple + (row[inside].astype(np.uint64) + np.uint64(1)) * BASE)
        _, number, times = np.unique(key, return_inverse=True, return_counts=True)
        again = inside[times[number] > 1]
        for k in range(3):
            covered[again + k] = True
    return _per_text(covered, first)


def repeated_lines(text: str) -> int:
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    return len(lines) - len(set(lines))


def measure_texts(texts: list[str], vocabulary: Pieces) -> dict[str, list | np.ndarray]:
    codes, begins = code_points(texts)
    at, end = word_spans(codes)
    first = np.searchsorted(at, begins)
    hashes = hash_spans(codes, at, end)
    n_words = np.diff(first)
    word_chars = _per_text(end - at, first)

    found, example, number = np.unique(hashes, return_index=True, return_inverse=True)

    def words(places: list[int]) -> list[str]:
        joined = "\n".join([*texts, ""])
        return [joined[a:b] for a, b in zip(at[example[places]].tolist(), end[example[places]].tolist())]

    ids, stop = vocabulary.pool.gather(vocabulary.pool.places(found, words)[number])
    edges = np.concatenate(([0], stop))[first]
    n_tokens = np.diff(edges)
    row = np.repeat(np.arange(len(texts)), n_tokens)
    cell, times = np.unique(row * vocabulary.size + ids, return_counts=True)
    share = times / n_tokens[cell // vocabulary.size]
    entropy = np.bincount(cell // vocabulary.size, -share * np.log2(share), minlength=len(texts)) + 0.0
    some = np.maximum(n_tokens, 1)
    scripts = script_table()[codes]
    owner = np.repeat(np.arange(len(texts)), np.diff(begins))
    letters = np.bincount(owner * len(NAMES) + scripts, minlength=len(texts) * len(NAMES)).reshape(len(texts), -1)
    letters[:, 0] = 0
    symbol = np.zeros(128, dtype=bool)
    symbol[[ord(c) for c in SYMBOLS]] = True
    return {
        "n_words": n_words,
        "word_chars": word_chars,
        "n_symbols": _per_text(symbol[np.minimum(codes, 127)], begins),
        "n_dup_lines": np.array([repeated_lines(t) for t in texts], dtype=np.int64),
        "n_repeat_words": repeated_words(hashes, first),
        "n_tokens": n_tokens,
        "script": [NAMES[i] for i in letters.argmax(axis=1)],
        "chars_per_token": word_chars / some,
        "byte_share": _per_text(vocabulary.is_byte[ids], edges) / some,
        "entropy": entropy,
    }


def measure(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Base counts and fertility per row of (doc_id, text)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            found = measure_texts(texts, pieces(vocabulary))
            yield pa.RecordBatch.from_arrays([part["doc_id"], *map(pa.array, found.values())], names=["doc_id", *found])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, {MEASURES}")


def percentiles(measured: DataFrame) -> DataFrame:
    """Per script its number of documents, and low, mid and high of each measure."""
    measures = ("chars_per_token", "byte_share", "entropy")
    cells = F.array(*[F.struct(F.lit(m), F.floor(F.col(m) * GRID)) for m in measures])
    counted = (
        measured.select("script", F.inline(cells).alias("measure", "cell"))
        .groupBy("script", "measure", "cell")
        .agg(F.count("*").alias("times"))
    )
    in_order = Window.partitionBy("script", "measure").orderBy("cell")
    walked = counted.withColumn("upto", F.sum("times").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    walked = walked.withColumn("n", F.sum("times").over(Window.partitionBy("script", "measure")))

    def first(twentieths: int, measure: str) -> Column:
        reached = (20 * F.col("upto") >= twentieths * F.col("n")) & (F.col("measure") == measure)
        return F.min(F.when(reached, F.col("cell"))) / GRID

    places = {"low": 1, "mid": 10, "high": 19}
    found = [first(k, m).alias(f"{m}_{name}") for m in measures for name, k in places.items()]
    return walked.groupBy("script").agg(F.max("n").alias("n"), *found)


def bands(measured: DataFrame) -> DataFrame:
    """The limits of each script, from all measured documents that pass the base rules."""
    cpt, entropy = F.col("chars_per_token_mid"), F.col("entropy_mid")
    limits = {
        "cpt_low": F.least(cpt - MARGIN * (cpt - F.col("chars_per_token_low")), SLACK * cpt),
        "cpt_high": F.greatest(cpt + MARGIN * (F.col("chars_per_token_high") - cpt), cpt / SLACK),
        "share_high": F.greatest(MARGIN * F.col("byte_share_high"), F.lit(LEAST_SHARE)),
        "entropy_low": F.least(entropy - MARGIN * (entropy - F.col("entropy_low")), SLACK * entropy),
    }
    weight = F.col("n") / (F.col("n") + PRIOR)
    blended = []
    for name, learned in limits.items():
        tighter = F.greatest if name.endswith("_low") else F.least
        within = tighter(learned, F.lit(DEFAULT[name]))
        blended.append((weight * within + (1 - weight) * DEFAULT[name]).alias(name))
    return percentiles(measured.filter(~base_failed())).select("script", *blended)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def judge(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Per row of (doc_id, text): the measures, base_failed and kept."""
    measured = materialize(measure(docs, vocabulary), "fertility")
    limits = small_or_not(materialize(bands(measured), "bands"))  # one row per script
    inside = (
        F.col("chars_per_token").between(F.col("cpt_low"), F.col("cpt_high"))
        & (F.col("byte_share") <= F.col("share_high"))
        & (F.col("entropy") >= F.col("entropy_low"))
    )
    return (
        measured.join(limits, "script", "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))
        .drop(*DEFAULT)
    )
