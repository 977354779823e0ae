"""Secrets, word runs and vector codes against brute force."""

import base64
import hashlib
import random
import re
import string
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from chartloom.llm import secrets, vector_codes, word_runs
from chartloom.llm.common import rows_of, table
from chartloom.llm.queries import QUERIES, with_periods

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _sorted(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.fixture(scope="module")
def all_texts(spark, sf_dir):
    return [(r.doc_id, r.text) for r in rows_of(table(spark, sf_dir, "documents")).collect()]


# op11

FORMS = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}


def _base_spans(text):
    found = []
    for rank, (kind, (form, group, least)) in enumerate(FORMS.items()):
        for m in re.finditer(form, text or "", re.ASCII):
            if len(m[group]) >= least:
                found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return [name for *_, name in sorted(found)]


def test_secrets_of_all_documents(spark, sf_dir, all_texts):
    got = {r.doc_id: r for r in QUERIES["op11_token_efficiency"](spark, sf_dir).collect()}
    assert len(got) == len(all_texts)
    for doc_id, text in all_texts:
        want = _base_spans(text)
        row = got[doc_id]
        kinds = [name.split(":")[0] for name in want]
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(map(kinds.count, FORMS))
        assert row.base_sha256 == _sha(",".join(want))
        spans = row.spans.split(",") if row.spans else []
        assert [s for s in spans if not s.startswith("random")] == want


def _spans(text, known=()):
    return secrets.find_spans(text, secrets.vocabulary_of(RANKS), frozenset(known))


def test_forms_of_secrets():
    assert _spans("ToKeN' : \"abcdefghijkl. x") == [("assign", 0, 23)]
    # too short a value drops the match, and what it covered stays covered
    assert _spans('secret=token="abcdefghijklmnop"') == []
    assert _spans("AKIA" + "A" * 13) == [] and _spans("xAKIA" + "A" * 14) == [("access", 1, 19)]
    assert _spans("zz" + "0" * 15 + " " + "0f" * 8) == [("hex", 18, 34)]
    # letters that only fold to ASCII ones are others
    assert _spans("ſecret=abcdefghijklmnop") == [] and _spans("toKen=abcdefghijklmnop") == []
    assert _spans("漢字😀 password=0123456789ab") == [("assign", 4, 25)]


def test_random_strings_are_found_and_others_are_not():
    rng = random.Random(3)
    for alphabet, most_missed in ((string.ascii_letters + string.digits, 0), (string.ascii_uppercase + string.digits, 2)):
        drawn = ["".join(rng.choices(alphabet, k=rng.randint(24, 60))) for _ in range(300)]
        missed = [s for s in drawn if not any(k == "random" for k, *_ in _spans(f"see {s}, please"))]
        assert len(missed) <= most_missed
    harmless = [
        "d41d8cd98f00b204e9800998ecf8427e", "DA39A3EE5E6B4B0D3255BFEF95601890AFD80709",
        "sha256-47DEQpj8HBSa+/TImW+5JCeuQeRkm5NMpJWZG3hSuFU=", "123e4567-e89b-12d3-a456-426614174000",
        "2024-01-02T03-04-05-0000", "49152-1181-23111-99812-1", "internationalization_of_things",
        "usr/local/lib/python/site-packages", "Geschwindigkeitsbegrenzung", "getUserByIdentifierAndName",
        "xqzjkvbwxqzjkvbwxqzjkvbw", "-" * 40, "=" * 40, "a" * 100_000,
    ]
    for text in harmless:
        assert [s for s in _spans(text) if s[0] == "random"] == [], text
    key = "Zk3vQ9xT1LmP7aYw2RsD8uHc"
    assert _spans(key) == [("random", 0, 24)] and _spans(key, [key]) == []
    # one that a secret of another kind covers is not told twice
    assert _spans(f"token={key}") == [("assign", 0, 30)]


def test_clean_documents_have_no_random_strings(all_texts):
    encoding = secrets.vocabulary_of(RANKS)
    for _, text in all_texts:
        for kind, start, end in secrets.find_spans(text or "", encoding, frozenset()):
            assert kind != "random" or re.search(r"[0-9]|[a-z][A-Z]", text[start:end])


def test_secrets_of_odd_rows(spark, odd, none):
    got = secrets.find_secrets(odd, RANKS)
    assert got.columns == ["doc_id", "spans"] and got.count() == odd.count()
    want = [(r.doc_id, [tuple(s) for s in _spans(r.text or "")]) for r in odd.collect()]
    assert _sorted((r.doc_id, [tuple(s) for s in r.spans]) for r in got.collect()) == _sorted(want)
    assert secrets.find_secrets(none, RANKS).count() == 0
    long = ("word " * 50 + "key: Zk3vQ9xT1LmP7aYw2RsD8uHc ") * 10_000  # 2.8 million characters
    assert len(_spans(long)) == 10_000
    named = odd.select(F.col("node").alias("doc_id"), "text", F.lit(1).alias("spans"))
    assert secrets.find_secrets(named, RANKS).count() == odd.count()


def test_too_many_known_strings_are_refused(odd):
    with pytest.raises(ValueError):
        secrets.find_secrets(odd, RANKS, map(str, range(secrets.MOST_KNOWN + 1)))


# op12


def _runs(words):
    """All runs by trying each period."""
    seen, found = set(), []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q) and (i, length) not in seen:
                seen.add((i, length))
                found.append((i, length, q))
            i = j + 1 if j > i else i + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_runs_equal_those_of_all_periods():
    rng = random.Random(5)
    for _ in range(1500):
        words = rng.choices(range(1, rng.choice([2, 3, 3, 4]) + 1), k=rng.randint(0, 60))
        if rng.random() < 0.7 and len(words) > 5:
            a, p = rng.randrange(len(words)), rng.randint(1, 5)
            words = [w if i < a + p else words[a + (i - a) % p] for i, w in enumerate(words)]
        if rng.random() < 0.3:
            words = (words + [1, 2]) * rng.randint(1, 5)
        names = [str(w).encode() for w in words]
        assert word_runs.text_runs(names) == _runs(words)
        if len(words) >= 6:
            assert word_runs.runs_of(words) == _runs(words)


def test_common_extensions():
    rng = random.Random(6)
    words = rng.choices([1, 2], k=200)
    tree = word_runs.ExtensionTree(words)
    for _ in range(500):
        a, b = rng.sample(range(len(words)), 2)
        want = next((k for k in range(200) if max(a, b) + k >= 200 or words[a + k] != words[b + k]))
        assert tree.common(np.array([a]), np.array([b])) == [want]


def test_cutting_stops_in_time():
    # each turn takes one word off either end of what is left
    words = [b"%d" % min(i, 99 - i) for i in range(100)] * 2 + [b"x"] * 9
    assert word_runs.text_runs(words) == [(200, 9, 1)]


def _row(doc_id, text):
    words = _words(text)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = _runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    first = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    milli = 1000 * first[1] // first[2] if runs else None
    return (doc_id, len(runs), *first, milli, _sha("".join("%d,%d,%d\n" % r for r in runs)), _sha(kept))


def test_runs_of_all_documents(spark, sf_dir, all_texts):
    got = QUERIES["op12_word_runs"](spark, sf_dir).collect()
    assert _sorted(got) == _sorted(_row(*row) for row in all_texts)


def test_periods_are_planted_in_a_tenth(spark, odd):
    got = with_periods(rows_of(odd))
    changed = [r for r in got.collect() if r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 10]
    kept = [r for r in rows_of(odd).collect() if r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 10]
    assert _sorted(changed) == _sorted(kept)


def test_runs_of_odd_rows(spark, odd, none):
    got = word_runs.find_runs(odd)
    assert got.columns == ["doc_id", "n_words", "runs", "collapsed"]
    want = []
    for row in odd.collect():
        words, runs = _words(row.text), [tuple(r) for r in _runs(_words(row.text))] if row.doc_id != 13 else [(0, 20_000, 1)]
        dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
        want.append((row.doc_id, len(words), runs, " ".join(w for i, w in enumerate(words) if i not in dropped)))
    assert _sorted((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in got.collect()) == _sorted(want)
    assert word_runs.find_runs(none).count() == 0
    # over a million words, most of which no tree sees
    words = [b"w%d" % i for i in range(1_000_000)] + [b"a", b"b"] * 10_000
    assert word_runs.text_runs(words) == [(1_000_000, 20_000, 2)]


# op13


def _codes(rows):
    """The contract in plain Python: rows of (vec_id, embedding, label)."""
    kept = [
        (i, [int(np.floor(4096 * float(x))) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    if not kept:
        return []
    size = len(kept[0][1]) // 8
    cut = lambda v: [v[p * size : (p + 1) * size] for p in range(8)]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:16]
    books = [[cut(v)[p] for _, v, _ in first] for p in range(8)]

    def nearest(book, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), k) for k, entry in enumerate(book))

    for _ in range(6):
        held = [defaultdict(list) for _ in range(8)]
        for _, v, _ in kept:
            for p, part in enumerate(cut(v)):
                held[p][nearest(books[p], part)[1]].append(part)
        for p in range(8):
            for k, parts in held[p].items():
                books[p][k] = [sum(c) // len(parts) for c in zip(*parts)]
    digest = _sha(",".join(str(x) for book in books for entry in book for x in entry))
    coded = []
    for i, v, label in kept:
        found = [nearest(books[p], part) for p, part in enumerate(cut(v))]
        coded.append((i, label, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
    total = defaultdict(int)
    for _, label, _, error in coded:
        total[label] += error
    return [(i, code, error, total[label], digest) for i, label, code, error in coded]


def test_codes_of_all_vectors(spark, sf_dir):
    got = QUERIES["op13_vector_codes"](spark, sf_dir).collect()
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label").collect()
    assert _sorted(got) == _sorted(_codes(vectors))


def _compressed(df, **names):
    coded, books = vector_codes.compress(df, **names)
    return _sorted((r.vec_id, r.code, r.error, r.label_error, books.digest()) for r in coded.collect())


def test_codes_of_odd_vectors(spark):
    rng = random.Random(7)
    rows = [(i % 40, [rng.choice([-1.0, -0.5, 0.0, 0.25, 3.0]) for _ in range(16)], i % 3 if i % 5 else None) for i in range(120)]
    rows += rows[:10] + [(None, [0.5] * 16, 1), (7, None, 1), (8, [None] + [0.0] * 15, 2), (9, [float("nan")] * 16, None)]
    rows += [(10, [float("inf")] * 16, 1), (11, [float("-inf")] + [0.0] * 15, 1)]
    schema = "vec_id long, embedding array<float>, label int, v string, code string, error string, label_error int, _rows int"
    wide = lambda some: spark.createDataFrame([(*r, "x", "x", "x", 1, 2) for r in some], schema)
    assert _compressed(wide(rows).repartition(5)) == _sorted(_codes(rows))
    # other lengths are dropped; fewer rows than entries; none at all
    assert _compressed(wide([*rows, (0, [], 1), (1, [1.0] * 15, 1), (2, [1.0] * 8, 1)])) == _sorted(_codes(rows))
    assert _compressed(wide(rows[:5])) == _sorted(_codes(rows[:5]))
    assert _compressed(wide([])) == [] and _compressed(wide([(1, None, 1)])) == []
    assert _compressed(wide([(1, [], 1), (2, [], None)])) == [
        (1, "00" * 8, 0, 0, _sha("")), (2, "00" * 8, 0, 0, _sha(""))
    ]
    # beyond the limit components are equal
    huge = [(i, [x] * 8, 1) for i, x in enumerate([3e38, -3e38, 1e9, 1.0] * 5)]
    capped = [(i, [max(-4096.0, min(4096.0, x)) for x in v], label) for i, v, label in huge]
    assert _compressed(wide(huge)) == _sorted(_codes(capped))


def test_names_of_columns_are_free(spark):
    rows = spark.createDataFrame([("a", [1.0] * 8, "x", 1), ("b", [2.0] * 8, None, 2)], "label string, v array<double>, vec_id string, embedding int")
    coded, _ = vector_codes.compress(rows, id_col="label", vector_col="v", label_col="vec_id")
    assert _sorted(coded.select("vec_id", "label", "code", "error").collect()) == _sorted(
        [("a", "x", "00" * 8, 0), ("b", None, "01" * 8, 0)]
    )


@pytest.mark.parametrize("colliding", [False, True])
def test_cells_leave_out_no_nearest_entry(monkeypatch, colliding):
    if colliding:
        monkeypatch.setattr(vector_codes, "mix", lambda x: x % np.uint64(97))
    rng = np.random.default_rng(1)
    book = rng.integers(-2000, 2000, (16, 3))
    book[5] = book[3]
    parts = np.concatenate((rng.integers(-3000, 3000, (5000, 3)), book, book + 1))
    distance = ((parts[:, None, :] - book) ** 2).sum(axis=2)
    for width, most in ((1, 1 << 16), (100, 50), (768, 1 << 16), (100_000, 10)):
        memo = vector_codes.CellMemo(book, width, most)
        for some in (slice(0, 2000), slice(1000, None)):
            chosen, least = memo.nearest(parts[some])
            assert (chosen == distance[some].argmin(axis=1)).all() and (least == distance[some].min(axis=1)).all()
    assert vector_codes.CellMemo(book, 100).undominated(parts[:500] // 100).sum() < 500 * 8


def test_cells_are_remembered(monkeypatch):
    memo = vector_codes.CellMemo(np.arange(48).reshape(16, 3) * 50)
    parts = np.random.default_rng(2).integers(-500, 2500, (300, 3))
    first = memo.nearest(parts)
    monkeypatch.setattr(memo, "undominated", None)
    assert all((a == b).all() for a, b in zip(memo.nearest(parts[::-1]), first, strict=True) for a, b in [(a[::-1], b)])


def test_label_errors_with_more_labels_than_are_broadcast(spark):
    labels = ["hot"] * 300 + [f"l{i}" for i in range(200)] + [None] * 50
    coded = spark.createDataFrame([(i, label, "", i) for i, label in enumerate(labels)], "vec_id long, label string, code string, error long")
    total = defaultdict(int)
    for i, label in enumerate(labels):
        total[label] += i
    for most in (10, 1000):
        got = vector_codes.with_label_error(coded, broadcast_rows=most)
        assert _sorted((r.vec_id, r.label_error) for r in got.collect()) == _sorted((i, total[label]) for i, label in enumerate(labels))
