"""Benchmark decontamination with a distributed positional inverted index.

The postings of every test term in the training documents are stored once, as
rows (term, document, position).  A test window is then looked up by its terms
alone: the postings of its rarest term, shifted by the term's offset, give the
candidate starts; they are intersected with the shifted postings of the next
rarest term, and what is left with those of all remaining terms.

The index lies as it was scanned, so building it shuffles nothing.  Every join
on postings has the position in its key and so has no hot key.  The test side
(windows, their terms) is the stated query set.

Documents with null or empty text have no words.  Repeated document rows give
one result each.  Items without a word, or with null text, are never found;
items with a null id are found under the id ''.  Empty tables give empty or
clean results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.llm.common import materialize, rows_of, same, small_or_not

# What lies between words, once A-Z count as a-z.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW_WORDS = 10
# Stands behind the last word of each document, so that its position is the
# number of words.  No word contains this character.
END = "\x00"
END_TERM = -1
DOC = ("doc_id", "text_hash")


def split_words(text: Column) -> Column:
    """The words of a text in their original case."""
    parts = F.split(F.coalesce(text, F.lit("")), BETWEEN_WORDS, -1)
    return F.filter(parts, lambda w: w != "")


def lower_ascii(word: Column) -> Column:
    """A-Z in lower case, any other letter unchanged."""
    ascii_only = F.octet_length(word) == F.length(word)
    return F.when(ascii_only, F.lower(word)).otherwise(F.translate(word, UPPER, UPPER.lower()))


@dataclass
class PhraseIndex:
    """Stored postings and the test windows they can answer.

    postings: term_id, doc_id, text_hash, pos; the row of term END_TERM holds
    the number of words.  windows: window_id, n_terms, item_ids.  terms:
    window_id, off, term_id, rank (1 is the rarest) of windows whose terms all
    occur in the documents.
    """

    postings: DataFrame
    windows: DataFrame
    terms: DataFrame


def test_windows(items: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """Distinct runs of ``window`` item words with the items that contain them."""
    words = F.transform(split_words(F.col("text")), lower_ascii)
    return (
        items.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("item_id"), words.alias("w"))
        .filter(F.size("w") > 0)
        .select("item_id", "w", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))).alias("s"))
        .groupBy(F.slice("w", F.col("s") + 1, window).alias("terms"))
        .agg(F.collect_set("item_id").alias("item_ids"))
        .select(F.monotonically_increasing_id().alias("window_id"), "terms", F.size("terms").alias("n_terms"), "item_ids")
    )


def build_index(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS) -> PhraseIndex:
    """Write the postings of all test terms; ``docs`` and ``items`` have doc_id and text."""
    windows = materialize(test_windows(items, window), "test-windows")
    offsets = windows.select("window_id", F.posexplode("terms").alias("off", "term"))
    term_ids = materialize(
        offsets.select("term").distinct().select(F.monotonically_increasing_id().alias("term_id"), "term"),
        "test-terms",
    )
    ends = docs.sparkSession.createDataFrame([(END_TERM, END)], "term_id long, term string")
    wanted = materialize(term_ids.unionAll(ends), "test-terms")
    words = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.posexplode(F.concat(split_words(F.col("text")), F.array(F.lit(END)))).alias("pos", "word"),
    ).select(*DOC, "pos", lower_ascii(F.col("word")).alias("term"))
    postings = materialize(
        words.join(small_or_not(wanted), "term").select("term_id", *DOC, "pos"), "postings"
    )
    counts = postings.filter(F.col("term_id") != END_TERM).groupBy("term_id").agg(F.count("*").alias("n"))
    known = offsets.join(term_ids, "term").join(counts, "term_id", "left")
    of_window = Window.partitionBy("window_id")
    ranked = materialize(
        known.withColumn("rarest", F.min(F.coalesce("n", F.lit(0))).over(of_window))
        .filter(F.col("rarest") > 0)
        .select(
            "window_id",
            "off",
            "term_id",
            F.row_number().over(of_window.orderBy("n", "off")).alias("rank"),
        ),
        "window-terms",
    )
    return PhraseIndex(postings, windows.select("window_id", "n_terms", "item_ids"), ranked)


def _candidates(index: PhraseIndex) -> DataFrame:
    """Starts proposed by the postings of each window's rarest term, and where that term is."""
    rarest = small_or_not(materialize(index.terms.filter("rank = 1").drop("rank"), "rarest"))
    return (
        index.postings.join(rarest, "term_id")
        .select(*DOC, "window_id", (F.col("pos") - F.col("off")).alias("start"), F.col("pos").alias("at"))
        .distinct()
    )


def exact_matches(index: PhraseIndex) -> DataFrame:
    """(doc_id, text_hash, window_id, start, n_terms) of every exact occurrence."""
    key = (*DOC, "term_id", "pos")
    second = index.terms.filter("rank = 2")
    sizes = small_or_not(index.windows.select("window_id", "n_terms"))
    found = _candidates(index).filter("start >= 0").drop("at").join(sizes, "window_id")
    asked = found.join(small_or_not(materialize(second, "second")), "window_id", "left").withColumn(
        "pos", F.col("start") + F.col("off")
    )
    lists = index.postings.join(
        small_or_not(materialize(second.select("term_id").distinct(), "second-terms")), "term_id", "left_semi"
    )
    # windows of one term have no second list and are complete
    two = materialize(
        asked.filter("off is not null")
        .join(lists, same(asked, lists, *key), "left_semi")
        .unionByName(asked.filter("off is null"))
        .select(*DOC, "window_id", "start", "n_terms"),
        "two-rarest",
    )
    hit_docs = small_or_not(materialize(two.select(*DOC).distinct(), "candidate-docs"), 1_000_000)
    rest = index.postings.join(hit_docs, same(index.postings, hit_docs, *DOC), "left_semi")
    asked = two.join(index.terms.filter("rank > 2"), "window_id").withColumn("pos", F.col("start") + F.col("off"))
    complete = (
        asked.join(rest, same(asked, rest, *key), "left_semi")
        .groupBy(*DOC, "window_id", "start", "n_terms")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") == F.col("n_terms") - 2)
        .drop("n")
    )
    return materialize(two.filter("n_terms <= 2").unionByName(complete), "matches")


def proximity_matches(index: PhraseIndex, slack: int) -> DataFrame:
    """Places of rarest terms around which all terms of the window occur, in any
    order, at most the window's length and ``slack`` words away:
    (doc_id, text_hash, window_id, at)."""
    sizes = small_or_not(index.windows.select("window_id", "n_terms"))
    near = _candidates(index).drop("start").join(sizes, "window_id")
    near = near.join(index.terms.select("window_id", "term_id").distinct(), "window_id")
    lists = index.postings
    close = F.abs(lists["pos"] - near["at"]) < near["n_terms"] + slack
    need = index.terms.groupBy("window_id").agg(F.count_distinct("term_id").alias("need"))
    return (
        near.join(lists, same(near, lists, *DOC, "term_id") & close, "left_semi")
        .groupBy(*DOC, "window_id", "at")
        .agg(F.count("*").alias("n"))
        .join(need, "window_id")
        .filter("n = need")
        .select(*DOC, "window_id", "at")
    )


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW_WORDS) -> DataFrame:
    """Per document row: doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated."""
    index = build_index(docs, items, window)
    matches = exact_matches(index)
    hits = (
        matches.select(*DOC, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("n_terms") - 1)).alias("pos"))
        .distinct()
        .groupBy(*DOC)
        .agg(F.count("*").alias("n_hit"))
    )
    found = (
        matches.select(*DOC, "window_id")
        .distinct()
        .join(small_or_not(index.windows.select("window_id", "item_ids")), "window_id")
        .select(*DOC, F.explode("item_ids").alias("item_id"))
        .groupBy(*DOC)
        .agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    )
    hit = hits.join(found, same(hits, found, *DOC)).select(hits["doc_id"], hits["text_hash"], "n_hit", "items")
    base = index.postings.filter(F.col("term_id") == END_TERM)
    items_col = F.coalesce("items", F.array().cast("array<string>"))
    return base.join(hit, same(base, hit, *DOC), "left").select(
        base["doc_id"],
        base["text_hash"],
        base["pos"].cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.size(items_col).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_col, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no test window occurs, with all their columns."""
    rows = rows_of(docs, id_col, text_col)
    bad = contamination(rows, items).filter("contaminated").select(*DOC)
    keyed = F.xxhash64(docs[text_col])
    return docs.join(bad, docs[id_col].eqNullSafe(bad["doc_id"]) & (keyed == bad["text_hash"]), "left_anti")
