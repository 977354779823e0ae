"""Language identification in two levels.

Texts become frequencies of hashed letter pairs and triples.  The first level
predicts the language family with linear support vector machines, one per
family against all others; the second tells the languages of that family apart
with one linear support vector machine for each pair of them.

The machines are fitted on a bounded sample: at most ``per_language`` labelled
documents of each language, spread evenly by a hash of their id.  Prediction
reads whole texts.  Families are listed in FAMILIES; a language not listed there
is a family of its own.

The score is the chance of the best family as a share of the two best, times the
mean chance in the pairs; it does not depend on how many families there are.
Null texts and texts without a letter are ``und`` with score 0, as is every text
if there is nothing to learn from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.llm.common import materialize, small_or_not, text_slices
from chartloom.llm.pretokens import LETTER, classes
from chartloom.llm.spans import code_points

DIMENSIONS_LOG2 = 12
PER_LANGUAGE = 400
UNDETERMINED = "und"
TEXTS_AT_ONCE = 200
# Language codes by family.
FAMILIES = {
    "germanic": ["en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb"],
    "romance": ["fr", "es", "it", "pt", "ro", "ca", "gl", "oc"],
    "slavic": ["ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"],
    "baltic": ["lt", "lv"],
    "uralic": ["fi", "et", "hu"],
    "turkic": ["tr", "az", "kk", "uz"],
    "indic": ["hi", "ur", "bn", "mr", "ne", "pa", "gu"],
    "semitic": ["ar", "he", "mt"],
    "chinese": ["zh", "yue"],
}


@dataclass
class Model:
    languages: list[str]
    families: list[str]
    members: dict[str, list[str]]
    weights: np.ndarray  # dimensions + 1 by machines: families, then pairs
    pairs: list[tuple[str, str]] = field(default_factory=list)


def family_of(language: str) -> str:
    return next((family for family, codes in FAMILIES.items() if language in codes), language)


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors of the texts (with a constant last), and how many letters each has."""
    size = 1 << DIMENSIONS_LOG2
    codes, begins = code_points([t.lower() for t in texts])
    letter = classes()[codes] == LETTER
    owner = np.repeat(np.arange(len(texts), dtype=np.int64), np.diff(begins))
    letters = np.bincount(owner[letter], minlength=len(texts))
    # every other character is the same blank; runs of blanks count once
    value = np.where(letter, codes, 0).astype(np.uint32)
    stay = np.ones(len(value), dtype=bool)
    stay[1:] = letter[1:] | letter[:-1] | (owner[1:] != owner[:-1])
    value, owner = value[stay], owner[stay]
    two = value[:-1] * np.uint32(0x9E3779B1) ^ value[1:] * np.uint32(0x85EBCA77)
    three = (two[:-1] * np.uint32(0xC2B2AE3D)) ^ value[2:] * np.uint32(0x27D4EB2F)
    counts = np.zeros(len(texts) * size)
    for grams, n in ((two, 2), (three, 3)):
        grams = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        bucket = (grams >> np.uint32(32 - DIMENSIONS_LOG2)).astype(np.int64)
        same = owner[: len(bucket)] == owner[n - 1 :]
        counts += np.bincount((owner[: len(bucket)] * size + bucket)[same], minlength=len(counts))
    x = np.sqrt(counts.reshape(len(texts), size))
    x /= np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-12)
    return np.hstack((x, np.ones((len(texts), 1)))).astype(np.float32), letters


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 1.0, epochs: int = 30) -> np.ndarray:
    """A linear machine with squared hinge loss, by dual coordinate descent."""
    x = x.astype(np.float64)
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    square = (x * x).sum(axis=1) + 0.5 / cost
    order = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(x)):
            step = max(alpha[i] - (y[i] * (x[i] @ w) - 1 + 0.5 * alpha[i] / cost) / square[i], 0.0) - alpha[i]
            if step:
                alpha[i] += step
                w += step * y[i] * x[i]
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w


def learning_sample(labelled: DataFrame, per_language: int) -> DataFrame:
    """At most ``per_language`` rows (doc_id, lang, text) of each language, the same every time."""
    counts = labelled.groupBy("lang").agg(F.count("*").alias("n"))
    limits = small_or_not(materialize(counts, "languages"))
    # thin out first, so that ranking sees a few rows only
    spread = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 20))
    thinned = (
        labelled.withColumn("spread", spread)
        .join(limits, "lang")
        .filter(F.col("spread") * F.col("n") <= F.lit(2.0 * per_language * (1 << 20)))
    )
    ranked = F.row_number().over(Window.partitionBy("lang").orderBy("spread", "doc_id", F.xxhash64("text")))
    return thinned.withColumn("r", ranked).filter(F.col("r") <= per_language).select("doc_id", "lang", "text")


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fit both levels on (doc_id, text, lang); rows without text or language teach nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches):
            for i in range(0, len(texts), TEXTS_AT_ONCE):
                x, letters = features(texts[i : i + TEXTS_AT_ONCE])
                some = np.flatnonzero(letters)
                yield pa.RecordBatch.from_arrays(
                    [part["lang"].take(pa.array(some + i)), pa.array([x[k].tobytes() for k in some], pa.binary())], names=["lang", "x"]
                )

    usable = labelled.select("doc_id", "text", "lang").filter("lang is not null and text is not null")
    # at most per_language vectors for each language come to the driver
    rows = learning_sample(usable, per_language).repartition(8, "doc_id").mapInArrow(run, "lang string, x binary").collect()
    rows.sort(key=lambda r: (r["lang"], bytes(r["x"])))
    lang = np.array([r["lang"] for r in rows], dtype=object)
    languages = sorted(set(lang.tolist()))
    members: dict[str, list[str]] = {}
    for name in languages:
        members.setdefault(family_of(name), []).append(name)
    families = sorted(members)
    if not rows:
        return Model([], [], {}, np.zeros(((1 << DIMENSIONS_LOG2) + 1, 0)))
    x = np.stack([np.frombuffer(r["x"], dtype=np.float32) for r in rows])
    family = np.array([family_of(name) for name in lang], dtype=object)
    columns = [fit_svm(x, np.where(family == f, 1.0, -1.0)) for f in families] if len(families) > 1 else [np.ones(x.shape[1])]
    pairs = [pair for f in families for pair in combinations(members[f], 2)]
    for one, other in pairs:
        both = (lang == one) | (lang == other)
        columns.append(fit_svm(x[both], np.where(lang[both] == one, 1.0, -1.0)))
    return Model(languages, families, members, np.stack(columns, axis=1), pairs)


def predict_texts(texts: list[str], model: Model) -> tuple[list[str], np.ndarray]:
    """A language and a score from 0 to 1 for each text."""
    x, letters = features(texts)
    n = len(texts)
    if not model.languages:
        return [UNDETERMINED] * n, np.zeros(n)
    chance = 1 / (1 + np.exp(-2 * (x @ model.weights)))
    f = len(model.families)
    best = chance[:, :f].argmax(axis=1)
    # against the second family only, so that the score does not fall with the number of families
    lead = np.sort(chance[:, :f], axis=1)[:, -2:]
    lead = lead[:, -1] / lead.sum(axis=1)
    # wins in pairs, then the sum of the chances, decide among the languages of a family
    index = {name: i for i, name in enumerate(model.languages)}
    wins, belief, duels = np.zeros((n, len(index))), np.zeros((n, len(index))), np.zeros(len(index))
    for k, (one, other) in enumerate(model.pairs):
        p = chance[:, f + k]
        for name, q, won in ((one, p, p >= 0.5), (other, 1 - p, p < 0.5)):
            wins[:, index[name]] += won
            belief[:, index[name]] += q
            duels[index[name]] += 1
    mean = np.where(duels, belief / np.maximum(duels, 1), 1.0)
    in_family = np.array([[name in model.members[fam] for name in model.languages] for fam in model.families])
    chosen = np.where(in_family[best], wins + mean / 2, -1.0).argmax(axis=1)
    score = lead * mean[np.arange(n), chosen]
    names = [model.languages[c] if some else UNDETERMINED for c, some in zip(chosen, letters)]
    return names, np.where(letters > 0, np.clip(score, 0, 1), 0.0)


def identify(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` with the predicted language and its score behind them."""
    kept = [c for c in docs.columns if c not in (lang_col, score_col)]
    schema = docs.select(*(F.col(f"`{c}`") for c in kept)).schema.add(lang_col, "string").add(score_col, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, text_col):
            names, scores = [], []
            for i in range(0, len(texts), TEXTS_AT_ONCE):
                found = predict_texts(texts[i : i + TEXTS_AT_ONCE], model)
                names += found[0]
                scores.append(found[1])
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(names, pa.string()), pa.array(np.concatenate(scores))],
                names=[*part.schema.names, lang_col, score_col],
            )

    return docs.select(*(F.col(f"`{c}`") for c in kept)).mapInArrow(run, schema)


def is_held_out(doc_id: str = "doc_id") -> Column:
    """The fifth of the documents that is never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))
