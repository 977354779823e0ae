"""Secrets in texts, found by their form and by how badly a vocabulary compresses them.

Three kinds have a form of their own: ``assign`` (a password, secret, token or
API key that is given a value), ``access`` (access key ids) and ``hex`` (runs of
hexadecimal digits).  Of each kind the leftmost matches that do not overlap
count; a match that is too short is dropped, and what it covered stays covered.

``random`` spans come from the token-efficiency test.  A candidate is a longest
run of LEAST_RANDOM or more characters of the alphabets of base64, with padding.
Words, paths and names of variables take few tokens of a public vocabulary, as
they consist of what it has learnt; a random string takes one for every one or
two characters.  Candidates of fewer than MOST_CHARS_PER_TOKEN characters per
token are reported, after these are set aside:

* digests in hexadecimal of the usual sizes, and base64 ones that name their
  algorithm;
* UUIDs, and numbers, dates and times with their separators;
* words, and words joined to names by hyphens, underscores or slashes: a word of
  a language the vocabulary does not know is cut short too;
* the strings given as ``known``;
* what lies within a span of another kind, as that is reported already.

Spans are code points of the text, the end exclusive, ordered by start and then
by kind.  Whole texts are searched, however long.  A null text counts as empty
and has no spans.  Each row is searched alone: repeated rows and rows with null
or repeated ids give equal results.  An id of any type is handed on; other
columns are not read, whatever their names.  An empty table gives an empty one.
"""

from __future__ import annotations

import base64
import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import cache
from itertools import accumulate

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame

from chartloom.llm.common import text_slices

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "random")
LEAST_VALUE, LEAST_ACCESS, LEAST_HEX, LEAST_RANDOM = 12, 18, 16, 20
MOST_CHARS_PER_TOKEN = 2.0
# Most literal strings that may be given as known; they travel with each task.
MOST_KNOWN = 100_000

# The forms of the three kinds.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
# A text without any of these, in lower case, holds no assignment.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

RUN = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % min(LEAST_HEX, LEAST_RANDOM))
HARMLESS = re.compile(
    "|".join(
        [
            r"(?:[0-9A-Fa-f]{32}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{56}|[0-9A-Fa-f]{64}|[0-9A-Fa-f]{96}|[0-9A-Fa-f]{128})",
            r"(?:sha1|sha224|sha256|sha384|sha512|md5)[-_/][A-Za-z0-9+/_-]+={0,2}",
            r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}",
            r"[0-9]+(?:[-+_/TZ][0-9]*)*",
            r"[-_/+]*(?:[A-Z]?[a-z]+|[A-Z]+)(?:[-_/+]+(?:[A-Z]?[a-z]+|[A-Z]+))*[-_/+]*={0,2}",
        ]
    )
)


@cache
def vocabulary_of(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> Iterator[tuple[int, str, int]]:
    """(start, kind, end) of the kinds with a form of their own."""
    folded = text.lower()
    if any(word in folded for word in ASSIGN_WORDS):
        for match in ASSIGN.finditer(text):
            if len(match[2]) >= LEAST_VALUE:
                yield match.start(), "assign", match.end()
    if "AKIA" in text:
        for match in ACCESS.finditer(text):
            if len(match[0]) >= LEAST_ACCESS:
                yield match.start(), "access", match.end()


def find_spans(text: str, encoding: tiktoken.Encoding, known: frozenset[str]) -> list[tuple[str, int, int]]:
    found = list(base_spans(text))
    candidates = []
    for run in RUN.finditer(text):
        # every run of hexadecimal digits that is long enough lies in such a run
        for match in HEX.finditer(run[0]):
            if match.end() - match.start() >= LEAST_HEX:
                found.append((run.start() + match.start(), "hex", run.start() + match.end()))
        if run.end() - run.start() >= LEAST_RANDOM and run[0] not in known and not HARMLESS.fullmatch(run[0]):
            candidates.append(run)
    if candidates:
        tokens = encoding.encode_ordinary_batch([run[0] for run in candidates], num_threads=1)
        spans = sorted((start, end) for start, _, end in found)
        starts = [start for start, _ in spans]
        furthest = list(accumulate((end for _, end in spans), max))  # of the spans up to each
        for run, ids in zip(candidates, tokens):
            start, end = run.span()
            before = bisect_right(starts, start)
            covered = before and furthest[before - 1] >= end
            if not covered and end - start < MOST_CHARS_PER_TOKEN * len(ids):
                found.append((start, "random", end))
    found.sort(key=lambda span: (span[0], KINDS.index(span[1])))
    return [(kind, start, end) for start, kind, end in found]


def find_secrets(docs: DataFrame, vocabulary: str, known: Iterable[str] = ()) -> DataFrame:
    """(doc_id, spans) per row of (doc_id, text); spans are structs of kind, start and end.

    ``vocabulary`` is the path of a file of tiktoken ranks; ``known`` are
    literal strings that are no secrets, such as the keys of a manual.
    """
    known = frozenset(known)
    if len(known) > MOST_KNOWN:
        raise ValueError(f"{len(known)} known strings; at most {MOST_KNOWN} travel with a task")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = vocabulary_of(vocabulary)
        for part, texts in text_slices(batches):
            spans = [[dict(zip(("kind", "start", "end"), s)) for s in find_spans(t, encoding, known)] for t in texts]
            yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(spans, pa.list_(span))], names=["doc_id", "spans"])

    schema = f"doc_id {id_type}, spans array<struct<kind:string,start:long,end:long>>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)
