"""Operators against brute force, the libraries, or a round trip."""

import hashlib
import itertools
import os
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import sentencepiece
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from chartloom.llm import (
    bpe_codec,
    components,
    decontamination,
    fertility,
    fuzzy_lines,
    language_id,
    near_dups,
    pretokens,
    rans,
    spans,
    substrings,
    token_files,
    transducer,
    warc,
)
from chartloom.llm.common import rows_of, table
from chartloom.llm.queries import ORACLE, QUERIES
from chartloom.llm.spans import code_points, hash_spans, word_spans
from chartloom.session import materialize, scratch_path
from compare import connect, differences

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_JSON = public_tokenizers.path("byte_bpe_50k.json")
WORD_JSON = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return rows_of(table(spark, sf_dir, "documents"))


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(name, spark, sf_dir):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name]) == []


def test_every_operator_has_a_query():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


# op1


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_contamination_on_odd_rows(spark, odd, none):
    items = spark.createDataFrame(
        [("b", "Word3 the lazy fox's jump, no 3 word4 THE"), ("a", "word3 the lazy fox s jump no 3 word4 the lazy fox"), ("c", "two"), (None, "one"), ("e", None), ("f", "...")],
        "doc_id string, text string",
    )
    got = sorted(map(tuple, decontamination.contamination(rows_of(odd), items).drop("text_hash").collect()), key=str)
    want = []
    for row in odd.collect():
        w = _words(row.text)
        hit, found = set(), set()
        for item in items.collect():
            iw = _words(item.text)
            for s in range(max(1, len(iw) - 9)) if iw else []:
                window = iw[s : s + 10]
                for i in range(len(w) - len(window) + 1):
                    if w[i : i + len(window)] == window:
                        hit.update(range(i, i + len(window)))
                        found.add(item.doc_id or "")
        names = ",".join(sorted(found))
        want.append((row.doc_id, len(w), len(hit), len(found), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    assert got == sorted(want, key=str)
    assert decontamination.contamination(rows_of(none), items).count() == 0
    clean = decontamination.contamination(rows_of(odd), items.limit(0))
    assert clean.count() == odd.count() and clean.filter("contaminated").count() == 0
    kept = decontamination.decontaminate(odd, items)
    assert kept.columns == odd.columns and kept.count() == sum(not w[-1] for w in want)


def test_proximity_finds_swapped_words(spark):
    docs = spark.createDataFrame([(1, "x delta beta gamma alpha y"), (2, "alpha " + "z " * 40 + "beta gamma delta")], "doc_id long, text string")
    items = spark.createDataFrame([("q", "alpha beta gamma delta")], "doc_id string, text string")
    index = decontamination.build_index(docs, items)
    assert decontamination.exact_matches(index).count() == 0
    assert {r.doc_id for r in decontamination.proximity_matches(index, 3).collect()} == {1}


# op2


def _base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    triples = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if triples[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return (
        len(words),
        sum(map(len, words)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
        len(words) < 50 or 100 * len(covered) > 50 * len(words),
    )


def test_fertility_base_counts(spark, odd, none, documents):
    for docs in (rows_of(odd), documents):
        judged = fertility.judge(docs, PIECES)
        got = Counter(
            (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in judged.collect()
        )
        assert got == Counter((r.doc_id, *_base(r.text)) for r in docs.collect())
        assert judged.filter("base_failed and kept").count() == 0
    assert fertility.judge(rows_of(none), PIECES).count() == 0


def test_fertility_measures_equal_those_of_single_words(documents, odd):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for docs in (rows_of(odd).filter("length(text) < 50000"), documents.limit(60)):
        rows = docs.collect()
        measured = fertility.measure(docs.sparkSession.createDataFrame(rows, docs.schema), PIECES).collect()
        got = sorted((str(r.doc_id), r.n_words, r.n_tokens, round(r.chars_per_token, 9), round(r.byte_share, 9), round(r.entropy, 9)) for r in measured)
        want = []
        for row in rows:
            words = re.findall(r"[^\x20\x09-\x0D]+", row.text or "")
            ids = [i for w in words for i in model.encode(w)]
            n = max(1, len(ids))
            entropy = sum(-k / n * np.log2(k / n) for k in Counter(ids).values())
            share = sum(model.is_byte(i) for i in ids) / n
            want.append((str(row.doc_id), len(words), len(ids), round(sum(map(len, words)) / n, 9), round(share, 9), round(entropy, 9)))
        assert got == [tuple(float(x) if isinstance(x, np.floating) else x for x in w) for w in sorted(want)]


def test_fertility_bands_depend_on_the_documents_alone(spark):
    random.seed(17)
    values = [(s, 10, 0, random.gauss(4, 1), random.random() / 9, random.gauss(6, 1)) for s, n in (("latin", 5000), ("thai", 29), ("han", 1)) for _ in range(n)]
    measured = spark.createDataFrame(values, "script string, n_words long, n_repeat_words long, chars_per_token double, byte_share double, entropy double")
    measured = measured.withColumn("n_words", F.lit(100))
    found = [sorted(fertility.bands(measured.repartition(n)).collect()) for n in (1, 3, 16)]
    assert found[0] == found[1] == found[2]
    for script, low, high, share, entropy in found[0]:
        own = [v for v in values if v[0] == script]
        weight = len(own) / (len(own) + fertility.PRIOR)
        at = lambda i, k: sorted(np.floor(v[i] * 1000) / 1000 for v in own)[-(-k * len(own) // 20) - 1]
        cpt, ent = at(3, 10), at(5, 10)
        learned = {
            "cpt_low": max(min(cpt - 6 * (cpt - at(3, 1)), 0.6 * cpt), 0.5),
            "cpt_high": min(max(cpt + 6 * (at(3, 19) - cpt), cpt / 0.6), 15),
            "share_high": min(max(6 * at(4, 19), 0.05), 0.5),
            "entropy_low": max(min(ent - 6 * (ent - at(5, 1)), 0.6 * ent), 1),
        }
        want = [weight * learned[name] + (1 - weight) * default for name, default in fertility.DEFAULT.items()]
        assert np.allclose([low, high, share, entropy], want)


def test_fertility_rejects_noise_and_keeps_prose(spark, documents):
    random.seed(3)
    noise = [(10**6 + i, " ".join("".join(random.choice("ĀęƠǄʣϞҔ֏߷ࢠ") for _ in range(9)) for _ in range(60 + i))) for i in range(5)]
    judged = fertility.judge(documents.unionAll(spark.createDataFrame(noise, "doc_id long, text string")), PIECES)
    assert judged.filter("doc_id >= 1000000 and kept").count() == 0
    sound = judged.filter("doc_id < 1000000 and not base_failed")
    assert sound.filter("kept").count() >= 0.97 * sound.count()


def test_fertility_limits_hold_if_a_third_is_noise(spark, documents):
    random.seed(16)
    n = documents.count() // 2
    noise = [(10**6 + i, " ".join("".join(random.choice("ĀęƠǄʣϞҔ֏߷ࢠ") for _ in range(9)) for _ in range(60 + i % 40))) for i in range(n)]
    judged = fertility.judge(documents.unionAll(spark.createDataFrame(noise, "doc_id long, text string")), PIECES)
    assert judged.filter("doc_id >= 1000000 and kept").count() == 0
    sound = judged.filter("doc_id < 1000000 and not base_failed")
    assert sound.filter("kept").count() >= 0.97 * sound.count()


# op3


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def _roots(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_fuzzy_lines_against_all_pairs(spark, odd, documents):
    long_line = " ".join(f"token{i}" for i in range(90))
    extra = [(500 + i, long_line.replace("token7 ", f"tok{i} ") + "\nAlone " + "x" * i) for i in range(12)]
    docs = rows_of(odd).unionAll(spark.createDataFrame(extra, "doc_id long, text string")).unionAll(documents.filter("doc_id < 60"))
    lines = fuzzy_lines._lines(docs)
    nodes = {r.node: (r.h, r.line) for r in lines.collect()}
    links = [
        (a, b)
        for (a, (h, x)), (b, (g, y)) in itertools.combinations(sorted(nodes.items()), 2)
        if bin((h ^ g) & (2**64 - 1)).count("1") <= fuzzy_lines.MOST_BITS
        and abs(len(x) - len(y)) <= 0.1 * max(len(x), len(y))
        and _distance(x, y) <= 0.1 * max(len(x), len(y)) + 1e-9
    ]
    root = _roots(nodes, links)
    assert len(links) > 10
    first = {}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    place = {(r.ord, r.th, r.line_no): r.node for r in lines.collect()}
    for key in sorted(place):
        first.setdefault(root[place[key]], key)
    drop = defaultdict(set)
    for key, node in place.items():
        if first[root[node]] != key:
            drop[key[:2]].add(key[2])
    hashes = {(r.doc_id, r.text): (r.ord, r.th) for r in docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(2**63 - 1)).alias("ord"), F.xxhash64("text").alias("th")).collect()}
    want = Counter()
    for name, text in rows:
        gone = drop[hashes[name, text]]
        kept = None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
        want[name, len(gone), kept] += 1
    assert Counter((r.row.doc_id, r.n_removed, r.kept) for r in fuzzy_lines.deduplicate(docs).collect()) == want
    assert fuzzy_lines.deduplicate(odd.limit(0)).count() == 0


def test_simhash_is_a_majority_for_any_number_of_words(spark):
    random.seed(5)
    rows = [([random.getrandbits(64) - 2**63 for _ in range(n)],) for n in (1, 2, 5, 62, 63, 64, 65, 200, 20000)]
    for row in spark.createDataFrame(rows, "hashes array<long>").select("hashes", fuzzy_lines.simhash(F.col("hashes")).alias("h")).collect():
        bits = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in row.hashes) > len(row.hashes))
        assert row.h & (2**64 - 1) == bits


def test_fuzzy_lines_find_all_short_pairs_by_edit_similarity_alone(spark):
    random.seed(11)

    def edited(text, n):
        text = list(text)
        for _ in range(n):
            i = random.randrange(len(text))
            text[i : i + 1] = random.choice(["", "z", text[i] + "y"])
        return "".join(text)

    base = ["".join(random.choice("abcdefgh ") for _ in range(n)) for n in range(9, 60)]
    texts = enumerate([*base, *(edited(x, n) for x in base for n in (1, 1, len(x) // 10, len(x) // 10))])
    docs = spark.createDataFrame(list(texts), "doc_id long, text string")
    lines = fuzzy_lines._lines(docs)
    nodes = {r.node: r.line for r in lines.collect()}
    links = [
        (a, b)
        for (a, x), (b, y) in itertools.combinations(sorted(nodes.items()), 2)
        if 10 * abs(len(x) - len(y)) <= max(len(x), len(y)) < fuzzy_lines.SHORT and 10 * _distance(x, y) <= max(len(x), len(y))
    ]
    assert len(links) > 100
    label = {r.node: r.label for r in fuzzy_lines.groups(lines).collect()}
    assert all(label.get(a, a) == label.get(b, b) for a, b in links)


def test_fuzzy_lines_find_a_changed_letter_or_word_at_every_length(spark):
    random.seed(12)
    rows = []
    for i in range(300):
        words = ["".join(random.choice("abcdefgh") for _ in range(random.randrange(2, 9))) for _ in range(13 + i // 2)]
        other = list(words)
        k = random.randrange(len(words))
        other[k] = "x" + words[k][1:] if i % 2 else "y" * len(words[k])
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    found = fuzzy_lines.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.row.doc_id for r in found.filter("n_removed = 1").collect()} == set(range(1, 600, 2))


def test_fuzzy_lines_move_texts_and_each_kind_of_keys_in_writes_of_their_own(spark, monkeypatch):
    plans = []

    def record(df, label, **options):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return materialize(df, label, **options)

    monkeypatch.setattr(fuzzy_lines, "materialize", record)
    monkeypatch.setattr(components, "materialize", record)
    docs = spark.createDataFrame([(1, "some line of a text that comes twice"), (2, "some line of a text that came twice")], "doc_id long, text string")
    assert {r.row.doc_id: r.n_removed for r in fuzzy_lines.deduplicate(docs).collect()} == {1: 0, 2: 1}
    assert [label for label, _ in plans[:4]] == ["lines", "distinct-lines", "shared-buckets", "shared-buckets"]
    dealt = [[plan.count(f"Exchange hashpartitioning({by}") for by in ("node", "key")] for _, plan in plans[1:4]]
    assert dealt == [[1, 0], [0, 1], [0, 1]]


def test_simhashes_of_lines_are_those_of_their_words(spark):
    random.seed(14)
    texts = [" ".join(random.choice("abcdefgh") * random.randrange(1, 4) for _ in range(n)) for n in (1, 2, 3, 30, 63, 64, 65, 400)]
    docs = spark.createDataFrame([(i, x + end) for i, x in enumerate(texts) for end in ("", ".") if end or i % 2], "doc_id long, text string")
    lines = fuzzy_lines._lines(docs)
    want = {}
    for r in lines.collect():
        want[r.node] = min(want.get(r.node, r.h), r.h)
    assert {r.node: r.h for r in fuzzy_lines._simhashes(fuzzy_lines._once(lines)).collect()} == want


def test_keys_of_lines_are_made_once(spark):
    once = fuzzy_lines._once(fuzzy_lines._lines(spark.createDataFrame([(1, "some line of a text")], "doc_id long, text string")))
    for keys in fuzzy_lines._keys(once):
        assert not re.search(r"size\((array|split|regexp|CASE)", keys._jdf.queryExecution().optimizedPlan().toString())


def test_long_lines_of_few_words_are_found(spark):
    rows = [(1, "some word " * 900), (2, "some word " * 880), (3, "a few more of the words that come again " * 60), (4, "a few more of the words that come again " * 58)]
    found = fuzzy_lines.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.row.doc_id: r.n_removed for r in found.collect()} == {1: 0, 2: 1, 3: 0, 4: 1}


def test_a_gram_further_off_than_edits_allow_makes_no_pair(spark, monkeypatch):
    random.seed(15)
    pairs = []

    def record(df, label, **options):
        written = materialize(df, label, **options)
        pairs.extend(written.collect() if label == "pairs" else [])
        return written

    def words(n):
        return ["".join(random.choice("abcdefgh") for _ in range(9)) for _ in range(n)]

    monkeypatch.setattr(components, "materialize", record)
    shared, line = words(3), words(20)
    far = [" ".join([*shared, *words(17)]), " ".join([*words(17), *shared])]
    near = [" ".join(line), " ".join([*line[:3], "xx", *line[3:7], "abchgf", *line[8:]])]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate([*far, *near])], "doc_id long, text string")
    assert {r.row.doc_id: r.n_removed for r in fuzzy_lines.deduplicate(docs).collect()} == {0: 0, 1: 0, 2: 0, 3: 1}
    assert len({(r.u, r.v) for r in pairs}) == 1


def test_a_write_leaves_no_shuffle_files(spark):
    def files():
        roots = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for root in roots for _, _, names in os.walk(root) for f in names if f.startswith("shuffle_")}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    said, before = spark.conf.get(name), files()
    dealt = spark.range(1000).withColumn("k", F.xxhash64("id") % 7).groupBy("k").agg(F.sum("id").alias("s"))
    assert sum(r.s for r in materialize(dealt, "sums").collect()) == 499500
    assert files() == before
    assert spark.conf.get(name) == said


def test_edits_are_counted_without_common_ends(spark):
    random.seed(13)
    rows = []
    for n in (1, 2, 9, 40, 300, 700):
        for edits in (0, 1, n // 20, n // 10, n // 10 + 1, n // 4):
            one = [random.choice("ab \u00e9\U0001f600") for _ in range(n)]
            other = list(one)
            for _ in range(edits):
                i = random.randrange(len(other) + 1)
                other[i : i + random.randrange(2)] = random.choice(["", "b", "zz"])
            rows += [("".join(one), "".join(other), n // 10), ("".join(other), "".join(one), n // 10), ("".join(one), "".join(one) * 2, n // 10)]
    pairs = spark.createDataFrame(rows, "one string, other string, most int")
    found = pairs.select("*", fuzzy_lines._within(F.col("one"), F.col("other"), F.col("most")).alias("near"))
    want = pairs.select("*", F.expr("levenshtein(one, other) <= most").alias("near"))
    assert Counter(found.collect()) == Counter(want.collect())
    assert 0 < want.filter("near").count() < len(rows)


def test_fuzzy_lines_keys_are_dealt_out_once_and_not_kept_with_lines(spark, monkeypatch):
    written = {}

    def record(df, label, **options):
        written.setdefault(label, (df.columns, df._jdf.queryExecution().executedPlan().toString()))
        return materialize(df, label, **options)

    monkeypatch.setattr(fuzzy_lines, "materialize", record)
    monkeypatch.setattr(components, "materialize", record)
    rows = [(1, "some line of a text that comes twice\nshort one"), (2, "some line of a text that came twice\nshort ones"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.row.doc_id: r.n_removed for r in fuzzy_lines.deduplicate(docs).collect()} == {1: 0, 2: 2, 3: 0}
    assert set(written["lines"][0]) == {"ord", "th", "line_no", "node", "size", "line", "open_end"}
    assert "line-hashes" not in written
    assert written["shared-buckets"][1].count("Exchange hashpartitioning(key") == 1
    buckets = fuzzy_lines._buckets(fuzzy_lines._lines(docs))
    assert buckets.count() == buckets.distinct().count() > 30


# op4


def test_a_pair_of_open_nodes_comes_from_one_of_the_buckets_it_shares(spark):
    rows = spark.createDataFrame([(k, n) for k in range(24) for n in range(20) if (k + n) % 3], "key long, node long")
    kept = components._with_keys(rows)
    met = kept.alias("l").join(kept.alias("m"), F.expr("l.key = m.key and l.node < m.node") & components._first_meeting("l.", "m."))
    found = [(r.one, r.other) for r in met.select(F.col("l.node").alias("one"), F.col("m.node").alias("other")).collect()]
    assert sorted(found) == list(itertools.combinations(range(20), 2))


def test_open_pairs_are_formed_once_each(spark, monkeypatch):
    """Nodes that share 24 buckets and no link, as texts just below the threshold."""
    plans = []

    def record(df, label):
        if label == "pairs":
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return materialize(df, label)

    monkeypatch.setattr(components, "materialize", record)
    rows = [(k, n) for k in range(24) for n in range(20)]
    tried = []

    def verify(pairs):
        tried.extend((r.u, r.v) for r in pairs.collect())
        return pairs.filter("u + v = 37")

    labels = components.link_buckets(
        spark.createDataFrame(rows, "key long, node long"), verify, open_per_row=100, central=True,
        sketch=lambda nodes: nodes.withColumn("sketch", F.lit(0)), alike=lambda one, other: F.col(one + "sketch") == F.col(other + "sketch"),
    )
    assert sorted(tried) == list(itertools.combinations(range(20), 2))
    assert {r.node: r.label for r in labels.collect()} == {18: 18, 19: 18}
    assert "array_intersect" in plans[-1]


def _jaccard(a, b):
    return sum(1 / sum(max(a[y] / a[x], b[y] / b[x]) for y in {*a, *b}) for x in a if x in b)


def _shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return Counter([tuple(w)] if 0 < len(w) < 5 else zip(*(w[k:] for k in range(5))))


def test_near_duplicates_against_all_pairs(spark, odd, none, texts):
    random.seed(9)
    base = [f"v{random.randrange(500)}" for _ in range(150)]
    near = []
    for i in range(30):  # similar to the base, less so to each other
        words = list(base)
        for _ in range(2):
            words[random.randrange(150)] = f"n{i}"
        near.append((900 + i, " ".join(words)))
    near.append((899 + 40, " ".join(base)))
    chosen = [(k, texts[k]) for k in sorted(texts)[:120]] + near
    docs = spark.createDataFrame(chosen, "doc_id long, text string")
    bags = {k: _shingles(t) for k, t in chosen}
    links = [(a, b) for a, b in itertools.combinations(sorted(bags), 2) if bags[a] and bags[b] and bags[a].keys() & bags[b].keys() and _jaccard(bags[a], bags[b]) >= 0.8]
    root = _roots(bags, links)
    assert {r.doc_id: r.class_id for r in near_dups.classes(docs).collect()} == root
    kept = near_dups.keep_one(odd)
    assert kept.columns == odd.columns
    ids = Counter(r.doc_id for r in kept.collect())
    # the texts of 1, 2 and null are copies, 6 and 7 are near to them
    assert ids == Counter({1: 1, 2: 1, None: 1, **dict.fromkeys([3, 4, 5, 8, 9, 10, 11, 12, 13], 1)})
    assert near_dups.classes(rows_of(odd)).count() == odd.count()
    assert near_dups.classes(rows_of(none)).count() == 0 and near_dups.keep_one(none).count() == 0


def test_registers_estimate_probability_jaccard():
    random.seed(4)
    words = [f"w{i}" for i in range(400)]
    a, b = " ".join(words), " ".join(words[:300] + [f"z{i}" for i in range(100)] + words[:60])
    registers, some = near_dups.signatures([a, b, "", "x"])
    assert some.tolist() == [True, True, False, True]
    exact = near_dups.probability_jaccard([a], [b])[0]
    assert exact == pytest.approx(_jaccard(_shingles(a), _shingles(b)))
    assert abs((registers[0] == registers[1]).mean() - exact) < 0.15


def test_sketches_tell_pairs_far_below_the_threshold(spark):
    random.seed(5)
    base = [f"v{i}" for i in range(150)]

    def changed(n):
        words = list(base)
        for _ in range(n):
            words[random.randrange(150)] = f"x{random.random()}"
        return " ".join(words)

    texts = [(i, changed(i % 9)) for i in range(120)]
    docs = spark.createDataFrame(texts, "node long, text string")
    alike = near_dups._alike(0.8)
    some = near_dups._sketch(docs)(docs.select("node"))
    l, m = some.alias("l"), some.alias("m")
    met = {(r.u, r.v) for r in l.join(m, (F.col("l.node") < F.col("m.node")) & alike("l.", "m.")).select(F.col("l.node").alias("u"), F.col("m.node").alias("v")).collect()}
    bags = {k: _shingles(t) for k, t in texts}
    exact = {(a, b): _jaccard(bags[a], bags[b]) for a, b in itertools.combinations(range(120), 2)}
    assert {p for p, j in exact.items() if j >= 0.8} <= met
    assert not {p for p, j in exact.items() if j < 0.68} & met
    # those with many changes are linked to nothing, the others to the base
    links = [p for p, j in exact.items() if j >= 0.8]
    got = near_dups.classes(docs.select(F.col("node").alias("doc_id"), "text"))
    assert {r.doc_id: r.class_id for r in got.collect()} == _roots(bags, links)


def test_near_duplicates_at_exactly_the_threshold(spark):
    # 8 * e common shingles of 10 * e in all; the last e words differ
    pairs = []
    for e in range(1, 31):
        words = [f"p{e}_{k}" for k in range(8 * e + 4)]
        pairs.append((2 * e, 2 * e + 1, *(" ".join(words + [f"{side}{e}_{k}" for k in range(e)]) for side in "ab")))
    texts = spark.createDataFrame([row for u, v, a, b in pairs for row in ((u, a), (v, b))], "node long, text string")
    found = near_dups._verify(texts, near_dups.THRESHOLD)(spark.createDataFrame([p[:2] for p in pairs], "u long, v long"))
    assert {(r.u, r.v) for r in found.collect()} == {p[:2] for p in pairs}


# op5, op7, op10


def test_token_counts_equal_the_library(odd, none, documents):
    library = Tokenizer.from_file(BYTE_JSON)
    for docs in (rows_of(odd), documents):
        got = Counter(map(tuple, transducer.count_tokens(docs, BYTE_JSON).collect()))
        want = Counter((r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())
        assert got == want
    assert transducer.count_tokens(rows_of(none), BYTE_JSON).count() == 0


def test_splitter_finds_the_pre_tokens_of_the_pattern():
    random.seed(6)
    pattern = regex.compile(public_tokenizers.PATTERN)
    machine = transducer.counter(BYTE_JSON)
    library = Tokenizer.from_file(BYTE_JSON)
    alphabet = "abelrstvm'' \n\t  01é漢😀.!-  "
    cases = ["".join(random.choice(alphabet) for _ in range(random.randrange(400))) for _ in range(300)]
    codes, begins = transducer.code_points(cases)
    starts = transducer.pre_token_starts(codes, begins[1:] - 1)
    for case, a, b in zip(cases, begins[:-1], begins[1:] - 1):
        cuts = [i for i in range(a, b) if starts[i]] + [b]
        assert [case[i - a : j - a] for i, j in zip(cuts, cuts[1:])] == pattern.findall(case)
    assert transducer.count_texts(cases, machine).tolist() == [len(library.encode(c, add_special_tokens=False).ids) for c in cases]


def all_letters():
    """Texts that hold every letter and digit the library knows, in mixed surroundings."""
    random.seed(8)
    known = np.concatenate([pretokens._matches(r"\p{L}"), pretokens._matches(r"\p{N}")])
    chars = [chr(c) for c in known]
    random.shuffle(chars)
    chars += [chr(c) for c in random.sample(range(0x30000, 0x110000), 2000) if not 0xD800 <= c < 0xE000]
    runs = ["".join(chars[i : i + 50]) for i in range(0, len(chars), 50)]
    return [random.choice(["", " ", "x", "1", "!"]) + run + random.choice([" z", "9", "'s", "\n"]) for run in runs]


def test_later_letters_count_and_encode_as_in_the_libraries(spark):
    texts = all_letters()
    library = Tokenizer.from_file(BYTE_JSON)
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert transducer.count_texts(texts, transducer.counter(BYTE_JSON)).tolist() == want
    ranks = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_codec.read_ranks(RANKS), special_tokens={})
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    for row in bpe_codec.encode(docs, RANKS).select("doc_id", "ids").collect():
        assert np.frombuffer(bytes(row.ids), "<u4").tolist() == ranks.encode_ordinary(texts[row.doc_id])


def test_long_words_and_slices_are_counted_in_bounds(monkeypatch):
    random.seed(9)
    library = Tokenizer.from_file(BYTE_JSON)
    letters = "".join(random.choices("abcdefghijklmnopqrstuvwxyzé漢", k=300_000))
    machine = transducer.Counter(BYTE_JSON)
    states = len(machine.states)
    texts = [letters, "", f"some words {letters[:5000]} and more", "<|endoftext|>" + letters[:4097], " " * 9000 + "x", "7" * 8000]
    want = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert transducer.count_texts(texts, machine).tolist() == want
    assert len(machine.states) < states + 1000
    # many slices, and a table that is emptied between them
    monkeypatch.setattr(transducer, "SLICE", 500)
    monkeypatch.setattr(transducer, "MOST_STATES", 2000)
    words = [" ".join("".join(random.choices("abcdefgh", k=random.randint(1, 30))) for _ in range(2000)) for _ in range(3)]
    want = [len(e.ids) for e in library.encode_batch(words, add_special_tokens=False)]
    assert transducer.count_texts(words, machine).tolist() == want
    assert len(machine.states) < 2000 + 501 * 4


def test_frames_of_empty_documents_take_linear_time():
    n = 100_000
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.zeros(n, np.int32)), pa.array(np.arange(n)), pa.array([np.array([1], np.uint16).tobytes()] * n)],
        names=["file", "doc_id", "ids"],
    )
    freq = rans.shared_table(np.ones(4, dtype=np.int64))
    start = time.perf_counter()
    rows = list(token_files._write_frames(freq)(iter([batch])))
    assert sum(len(r["doc_ids"][0]) for r in rows) == n and time.perf_counter() - start < 30


def test_bpe_equals_the_library_and_decodes(odd, none, documents):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_codec.read_ranks(RANKS), special_tokens={})
    for docs in (rows_of(odd), documents):
        got = Counter(
            (r.doc_id, bytes(r.ids), bytes(r.decoded).decode()) for r in bpe_codec.decode(bpe_codec.encode(docs, RANKS), RANKS).collect()
        )
        coded = [(r.doc_id, r.text or "", library.encode_ordinary(r.text or "")) for r in docs.collect()]
        assert got == Counter((k, b"".join(i.to_bytes(4, "little") for i in ids), t) for k, t, ids in coded)
    assert bpe_codec.decode(bpe_codec.encode(rows_of(none), RANKS), RANKS).count() == 0


def test_token_files_equal_the_library(spark, odd, none, documents):
    library = Tokenizer.from_file(WORD_JSON)
    for docs in (documents, rows_of(odd)):
        path = scratch_path(spark, "token-files")
        token_files.write_corpus(docs, path, WORD_JSON, 1)
        got = sorted(((r.start, r.doc_id, len(r.ids) // 4, zlib.crc32(bytes(r.ids))) for r in token_files.read_corpus(spark, path).collect()))
        rows = docs.select("doc_id", "text", F.xxhash64("text").alias("th")).collect()
        start, want = 0, []
        for r in sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.th)):
            ids = [*library.encode(r.text or "", add_special_tokens=False).ids, 1]
            want.append((start, r.doc_id, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
            start += len(ids)
        assert got == want
    path = scratch_path(spark, "token-files")
    token_files.write_corpus(rows_of(none), path, WORD_JSON, 1)
    assert token_files.read_corpus(spark, path).count() == 0


def test_frames_round_trip_by_stretch_and_detect_damage():
    import numpy as np

    rng = np.random.default_rng(1)
    ids = np.minimum(rng.zipf(1.3, 400_000), 5000).astype(np.uint32)
    codec = rans.Codec(rans.shared_table(np.bincount(ids, minlength=6000)))
    for n in (0, 1, 63, 64, 1000, len(ids)):
        frame = codec.encode(ids[:n])
        assert (codec.decode(frame) == ids[:n]).all()
        parts = [codec.decode(frame, k) for k in range(rans.stretches(frame))]
        assert n == 0 or (np.concatenate(parts) == ids[:n]).all()
    with pytest.raises(ValueError):
        codec.decode(frame[:-1] + bytes([frame[-1] ^ 1]))
    assert len(frame) < len(ids) * 2


# op6


def test_languages_of_held_out_documents(spark, sf_dir, odd, none):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.filter(~language_id.is_held_out()))
    found = language_id.identify(docs.filter(language_id.is_held_out()), model)
    clear = found.filter("lang_pred <> 'und' and length(text) > 200")
    assert clear.filter("lang = lang_pred").count() >= 0.95 * clear.count()
    assert found.filter("score < 0 or score > 1").count() == 0
    seen = language_id.identify(odd, model)
    assert [c for c in odd.columns if c != "score"] == [c for c in seen.columns if c not in ("lang_pred", "score")]
    for r in seen.collect():
        assert (r.lang_pred == "und") == (not regex.search(r"\p{L}", r.text or ""))
    assert language_id.identify(none, model).count() == 0
    empty = language_id.fit(docs.limit(0))
    assert {r.lang_pred for r in language_id.identify(odd, empty).collect()} == {"und"}


def test_clean_texts_stay_with_many_families(spark):
    random.seed(15)
    for families in (2, 15, 30):
        rows = []
        for f in range(families):
            letters = random.sample("abcdefghijklmnopqrstuvwxyz", 8)
            for _ in range(20):
                words = ("".join(random.choices(letters, k=random.randrange(2, 7))) for _ in range(12))
                rows.append((len(rows), " ".join(words), f"x{f}"))
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        assert corpus_pipeline.language_identification(spark, docs, "").count() == len(rows), families
    # margins of 1 for one family and -1 for the others
    for n in (2, 15, 20, 100):
        names = [f"x{i}" for i in range(n)]
        weights = np.zeros(((1 << language_id.DIMENSIONS_LOG2) + 1, n))
        weights[-1] = [1, *[-1] * (n - 1)]
        found, scores = language_id.predict_texts(["some text"], language_id.Model(names, names, {x: [x] for x in names}, weights))
        assert found == ["x0"] and scores[0] == pytest.approx(0.8808, abs=1e-4)


# op8


def test_archive_round_trip_and_pushdown(spark, tmp_path):
    big = "<p>" + "x" * 200 + "</p>"
    rows = [(1, "http://a/\n", big), (2, None, big), (2, None, big), (None, "u", big), (3, "u", ""), (4, "u", None), (5, "u", "é" * 60_000), (6, "u", "é" * 60_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = str(tmp_path / "w")
    warc.write_archive(pages, path)
    back = warc.read_archive(spark, path)
    got = Counter((r.record_id, r.record_type, r.refers_to, r.payload_bytes) for r in back.collect())
    assert got == Counter(
        [("1", "response", None, 207), ("2", "revisit", "1", 207), ("2", "revisit", "1", 207), (None, "revisit", "1", 207)]
        + [("3", "response", None, 0), ("4", "response", None, 0), ("5", "response", None, 120_000), ("6", "revisit", "5", 120_000)]
    )
    one = back.filter("record_type = 'response' and record_id = '5'")
    assert [bytes(r.payload).decode() for r in one.collect()] == ["é" * 60_000]
    reader = warc.WarcReader({"path": path})
    list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit")]))
    assert sum(len(list(reader.read(p))) for p in reader.partitions()) == 4
    assert all(r.payload is None for r in warc.read_archive(spark, path, payload=False).collect())
    empty = str(tmp_path / "e")
    warc.write_archive(pages.limit(0), empty)
    assert warc.read_archive(spark, empty).count() == 0


# op9


def test_repeats_against_all_windows(spark, odd, none):
    random.seed(8)
    passage = [f"p{i}" for i in range(70)]
    rows = [(i, " ".join([f"a{i}_{k}" for k in range(random.randrange(60))] + passage[random.randrange(12) :] + [f"b{i}_{k}" for k in range(random.randrange(60))])) for i in range(40)]
    rows += [(100 + i, "same words again " * (17 + i)) for i in range(4)]
    docs = rows_of(odd).unionAll(spark.createDataFrame(rows, "doc_id long, text string"))
    split = [(r.doc_id, re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in docs.collect()]
    rank = lambda d: 2**63 - 1 if d is None else d
    first = {}
    for d, w in split:
        for i in range(len(w) - 49):
            key = tuple(w[i : i + 50])
            first[key] = min(first.get(key, rank(d)), rank(d))
    want = Counter()
    for d, w in split:
        gone = {k for i in range(len(w) - 49) if first[tuple(w[i : i + 50])] < rank(d) for k in range(i, i + 50)}
        want[d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    assert Counter(map(tuple, substrings.remove_repeats(docs).collect())) == want
    assert substrings.remove_repeats(rows_of(none)).count() == 0


def test_repeats_of_null_ids_stay_with_their_text(spark):
    passage, other = (" ".join(f"{c}{i}" for i in range(60)) for c in "pq")
    some = spark.range(200_000).select(*(F.concat(F.lit(t), F.lit(" n"), F.col("id").cast("string")).alias(c) for t, c in ((passage, "x"), (other, "y"))))
    x, y = some.select("x", F.hash("x").alias("h")), some.select("y", F.hash("y").alias("h"))
    met = x.join(y, "h").agg(F.min(F.struct("x", "y")).alias("m")).first().m  # equal in 32 bits
    docs = spark.createDataFrame([(1, passage), (None, met.x), (None, met.y)], "doc_id long, text string")
    got = {(r.doc_id, r.n_removed, r.kept) for r in substrings.remove_repeats(docs).collect()}
    assert got == {(1, 0, passage), (None, 60, met.x.split(" ")[-1]), (None, 0, met.y)}


# pipeline


def test_decoding_has_a_stage_of_its_own_in_the_pipeline(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(1201)], "doc_id long, text string")
    found = corpus_pipeline.bpe_encoding(spark, docs, "")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "FlatMapGroups" not in plan
    want = {(i, hashlib.sha256(f"text {i}".encode()).hexdigest()) for i in range(1201)}
    assert {(r.doc_id, r.decoded_sha256) for r in found.collect()} == want


def _most_memory(work):
    """MB that ``work`` takes at most, beyond what it finds."""
    tracemalloc.start()
    try:
        result = work()
        return tracemalloc.get_traced_memory()[1] / 1e6, result
    finally:
        tracemalloc.stop()


def test_workers_hold_little_memory_beside_a_block_of_texts(monkeypatch):
    taken, letters = _most_memory(lambda: pretokens._matches(r"\p{L}"))
    assert taken < 20 and len(letters) > 100_000
    texts = ["some words of a text, " * 1000] * 45
    pretokens.classes()
    codes, begins = code_points(texts)
    starts, ends = word_spans(codes)
    spans.powers(100)
    hash_spans(codes[:100], starts[:2], ends[:2])
    taken, found = _most_memory(lambda: hash_spans(codes, starts, ends))
    assert taken < 20 and len(found) == 45 * 5000 and len(set(found.tolist())) == 5
    monkeypatch.setattr(spans, "SPANS_AT_ONCE", 10**9)
    assert np.array_equal(found, hash_spans(codes, starts, ends))


def test_learning_takes_few_texts_at_a_time(monkeypatch, spark):
    seen = []

    class Rows:
        def mapInArrow(self, run, schema):
            batch = pa.RecordBatch.from_pylist([{"doc_id": i, "lang": "en" if i % 2 else "de", "text": f"text {i}" if i % 3 else "1"} for i in range(900)])
            self.rows = [r for out in run(iter([batch])) for r in out.to_pylist()]
            return self

        def repartition(self, *_):
            return self

        def collect(self):
            return self.rows

    whole = language_id.features
    monkeypatch.setattr(language_id, "learning_sample", lambda *_: Rows())
    monkeypatch.setattr(language_id, "features", lambda texts: (seen.append(len(texts)), whole(texts))[1])
    model = language_id.fit(spark.createDataFrame([(1, "a", "en")], "doc_id long, text string, lang string"))
    assert sum(seen) == 900 and max(seen) <= 200 and model.languages == ["de", "en"]


def test_copies_whose_lines_all_went_leave_the_pipeline(spark):
    rows = [(1, "a first line of text\nand a second one"), (2, "a first line of text\nand a second one"), (3, "and a second one\n"), (4, ""), (5, None), (6, "a first line of text\nown words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_chars", F.length("text").cast("long"))
    kept = corpus_pipeline.line_dedup(spark, docs, "")
    assert {(r.doc_id, r.text) for r in kept.collect()} == {rows[0], rows[3], rows[4], (6, "own words")}


def test_pipeline_on_odd_rows_and_on_tables(spark, sf_dir, odd, none):
    for docs in (odd, none, table(spark, sf_dir, "documents")):
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            path = scratch_path(spark, "stage")
            after = stage(spark, docs, sf_dir)
            assert after.columns == columns, name
            after.write.parquet(path)
            docs = spark.read.parquet(path)
        last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
        assert last.count() == docs.count()
        texts = {hashlib.sha256((r.text or "").encode()).hexdigest() for r in docs.collect()}
        assert {r.decoded_sha256 for r in last.collect()} == texts
