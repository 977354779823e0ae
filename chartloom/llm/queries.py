"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from chartloom.llm import (
    bpe_codec,
    decontamination,
    fertility,
    fuzzy_lines,
    language_id,
    near_dups,
    secrets,
    substrings,
    token_files,
    transducer,
    vector_codes,
    warc,
    word_runs,
)
from chartloom.llm.common import rows_of, table
from chartloom.session import scratch_path


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows_of(table(spark, sf_dir, "documents"))
    items = rows_of(table(spark, sf_dir, "benchmark"), "item_id")
    return decontamination.contamination(docs, items).drop("text_hash")


def op2_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows_of(table(spark, sf_dir, "documents"))
    return fertility.judge(docs, public_tokenizers.path("piece_bpe_32k.model"))


def op3_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows_of(table(spark, sf_dir, "documents"))
    return fuzzy_lines.deduplicate(docs).select(
        "row.doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256")
    )


def op4_near_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows_of(table(spark, sf_dir, "documents"))
    return near_dups.classes(docs).select("doc_id", "class_id")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows_of(table(spark, sf_dir, "documents"))
    counted = transducer.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.filter(~language_id.is_held_out()))
    return language_id.identify(docs.drop("lang"), model).select(
        "doc_id", language_id.is_held_out().alias("held_out"), "lang_pred", "score"
    )


def op7_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe_codec.encode(rows_of(table(spark, sf_dir, "documents")), vocabulary, written=True)
    return bpe_codec.decode(encoded, vocabulary).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    folder = scratch_path(spark, "warc")
    warc.write_archive(pages, folder)
    return warc.read_archive(spark, folder).select(
        F.col("record_id").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows_of(table(spark, sf_dir, "documents"))
    return substrings.remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-files")
    docs = rows_of(table(spark, sf_dir, "documents"))
    token_files.write_corpus(docs, folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_files.read_corpus(spark, folder).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op11_token_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = rows_of(table(spark, sf_dir, "documents"))
    found = secrets.find_secrets(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    base = F.filter("spans", lambda s: s.kind.isin(*secrets.BASE_KINDS))

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(number, secrets.BASE_KINDS),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


def with_periods(docs: DataFrame) -> DataFrame:
    """Documents, of which one in ten repeats the words from some place on.

    With h the CRC-32 of the decimal id: where h % 10 = 0, every word i >= a of
    n becomes word a + (i - a) % p, with a = h // 10 % n and
    p = 1 + (n - a) // (3 + h // 10 % 8).
    """
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    h = F.crc32(F.col("doc_id").cast("string"))
    split = docs.withColumn("_h", h).withColumn("_words", F.when(F.col("_h") % 10 == 0, words))
    place = "CAST(floor(_h / 10) AS BIGINT)"
    planned = split.withColumn("_a", F.expr(f"CAST({place} % nullif(size(_words), 0) AS INT)")).withColumn(
        "_p", F.expr(f"CAST(1 + floor((size(_words) - _a) / (3 + {place} % 8)) AS INT)")
    )
    rest = F.expr("slice(flatten(array_repeat(slice(_words, _a + 1, _p), 11)), 1, size(_words) - _a)")
    repeated = F.array_join(F.concat(F.slice("_words", 1, F.col("_a")), rest), " ")
    changed = F.when(F.size("_words") > 0, repeated).otherwise(F.col("text"))
    return planned.select("doc_id", changed.alias("text"))


def op12_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = word_runs.find_runs(with_periods(rows_of(table(spark, sf_dir, "documents"))))
    # the greatest length first, then the smallest start and period
    first = F.array_min(F.transform("runs", lambda r: F.struct(-r.length, r.start, r.period)))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    longest = found.withColumn("_first", first)
    start, length, period = F.col("_first.start"), -F.col("_first.col1"), F.col("_first.period")
    return longest.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.expr("(1000 * -_first.col1) div _first.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_fertility": op2_fertility,
    "op3_fuzzy_lines": op3_fuzzy_lines,
    "op4_near_dups": op4_near_dups,
    "op5_token_counts": op5_token_counts,
    "op6_language_id": op6_language_id,
    "op7_bpe_codec": op7_bpe_codec,
    "op8_warc": op8_warc,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_token_files": op10_token_files,
    "op11_token_efficiency": op11_token_efficiency,
    "op12_word_runs": op12_word_runs,
    "op13_vector_codes": op13_vector_codes,
}

# Words of a text for the SQL below.
_OP1_WORDS = (
    r"list_filter(regexp_split_to_array(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    r"'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
)
_OP9_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLE: dict[str, str] = {
    "op1_decontamination": f"""
        WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_OP1_WORDS.format('text')} AS ws FROM benchmark),
        bw AS (
            SELECT DISTINCT item_id, array_to_string(ws[i:i + 9], ' ') AS g, len(ws[i:i + 9]) AS n
            FROM (SELECT item_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 9))) AS i FROM b WHERE len(ws) > 0)
        ),
        d AS (SELECT doc_id, {_OP1_WORDS.format('text')} AS ws FROM documents),
        dw AS (
            SELECT doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') AS g
            FROM (
                SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS i
                FROM d, (SELECT DISTINCT n FROM bw)
            )
        ),
        m AS (SELECT DISTINCT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.g = bw.g AND dw.n = bw.n),
        h AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM m) GROUP BY doc_id
        ),
        f AS (
            SELECT doc_id, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
            FROM (SELECT DISTINCT doc_id, item_id FROM m) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN h USING (doc_id) LEFT JOIN f USING (doc_id)
    """,
    "op8_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest,
                   CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes
            FROM pages
        ),
        f AS (
            SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id
            FROM p
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id <> page_id THEN first_id END AS refers_to
        FROM f
    """,
    "op9_substring_dedup": f"""
        WITH d AS (SELECT doc_id, {_OP9_WORDS} AS ws FROM documents),
        w AS (
            SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS g
            FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 49)) AS i FROM d WHERE len(ws) >= 50)
        ),
        r AS (SELECT doc_id, i FROM w JOIN (SELECT g, min(doc_id) AS first FROM w GROUP BY g) USING (g) WHERE first < doc_id),
        c AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS p FROM r),
        o AS (SELECT doc_id, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS p FROM d),
        k AS (
            SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n_kept
            FROM o ANTI JOIN c USING (doc_id, p) GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, len(ws) - coalesce(n_kept, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)
    """,
}

# Decimal id to CRC-32, a byte and then a bit at a time.
_CRC32 = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length({0}) + 1), "
    "lambda i: ascii({0}[i])::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), "
    "[0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, z: xor(x >> 1, 3988292384::BIGINT * (x & 1)))), 4294967295::BIGINT)"
)

# A run of period q covers four multiples of q in a row, so only such periods are tried.
ORACLE["op12_word_runs"] = f"""
    WITH o AS (SELECT doc_id, {_CRC32.format('CAST(doc_id AS VARCHAR)')} AS h, {_OP9_WORDS} AS ws FROM documents),
    s AS (SELECT *, len(ws) AS n, h // 10 AS g FROM o),
    a AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM s),
    p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
    w AS MATERIALIZED (
        SELECT doc_id, i, CASE WHEN i >= a THEN ws[a + (i - a) % p + 1] ELSE ws[i + 1] END AS word
        FROM (SELECT *, unnest(range(0, n)) AS i FROM p)
    ),
    d AS MATERIALIZED (SELECT doc_id, list(word ORDER BY i) AS ws, count(*) AS n FROM w GROUP BY doc_id),
    q AS MATERIALIZED (
        SELECT DISTINCT doc_id, q
        FROM (SELECT *, unnest(range(0, (n - 1) // q - 2)) AS k FROM (SELECT *, unnest(range(1, n // 4 + 1)) AS q FROM d))
        WHERE ws[k * q + 1] = ws[k * q + q + 1] AND ws[k * q + 1] = ws[k * q + 2 * q + 1]
          AND ws[k * q + 1] = ws[k * q + 3 * q + 1]
    ),
    e AS (
        SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS stretch
        FROM (SELECT doc_id, q, ws, unnest(range(0, n - q)) AS i FROM q JOIN d USING (doc_id))
        WHERE ws[i + 1] = ws[i + q + 1]
    ),
    r AS MATERIALIZED (
        SELECT doc_id, start, length, min(q) AS period
        FROM (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM e GROUP BY doc_id, q, stretch)
        WHERE length >= greatest(6, 4 * q)
        GROUP BY doc_id, start, length
    ),
    f AS (
        SELECT doc_id, count(*) AS n_runs,
               first({{'s': start, 'l': length, 'p': period}} ORDER BY length DESC, start, period) AS f,
               sha256(string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period)) AS runs_sha256
        FROM r GROUP BY doc_id
    ),
    c AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
    k AS (SELECT doc_id, sha256(string_agg(word, ' ' ORDER BY i)) AS kept FROM w ANTI JOIN c USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, coalesce(n_runs, 0) AS n_runs, f.s AS start, f.l AS length, f.p AS period,
           1000 * f.l // f.p AS exponent_milli, coalesce(runs_sha256, sha256('')) AS runs_sha256,
           coalesce(kept, sha256('')) AS collapsed_sha256
    FROM documents LEFT JOIN f USING (doc_id) LEFT JOIN k USING (doc_id)
"""


def _codes_sql() -> str:
    parts, entries, rounds = vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS
    distance = "list_sum(list_transform(list_zip(x.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = [
        f"""
        k AS (
            SELECT row_number() OVER () AS row, vec_id, label,
                   list_transform(embedding, lambda c: CAST(floor({vector_codes.SCALE} * c) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda c: coalesce(NOT isfinite(c), true))) = 0
        ),
        x AS MATERIALIZED (
            SELECT row, part, v[part * len(v) // {parts} + 1:(part + 1) * len(v) // {parts}] AS v
            FROM (SELECT *, unnest(range(0, {parts})) AS part FROM k)
        ),
        b0 AS MATERIALIZED (
            SELECT part, entry, x.v
            FROM x JOIN (SELECT row, row_number() OVER (ORDER BY vec_id, v) - 1 AS entry FROM k) USING (row)
            WHERE entry < {entries}
        )"""
    ]
    for turn in range(rounds + 1):
        steps.append(f"""
        a{turn} AS MATERIALIZED (
            SELECT part, row, min({{'d': {distance}, 'e': entry}}) AS best FROM x JOIN b{turn} b USING (part) GROUP BY part, row
        )""")
        if turn < rounds:
            steps.append(f"""
        m{turn} AS (
            SELECT part, entry, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY place) AS v
            FROM (
                SELECT part, best.e AS entry, place, sum(c) AS s, count(*) AS n
                FROM (SELECT part, row, unnest(v) AS c, unnest(range(0, len(v))) AS place FROM x) JOIN a{turn} USING (part, row)
                GROUP BY ALL
            )
            GROUP BY part, entry
        ),
        b{turn + 1} AS MATERIALIZED (
            SELECT part, entry, coalesce(m{turn}.v, b{turn}.v) AS v FROM b{turn} LEFT JOIN m{turn} USING (part, entry)
        )""")
    return f"""
        WITH {','.join(steps)},
        c AS (
            SELECT row, string_agg(printf('%02x', CAST(best.e AS INTEGER)), '' ORDER BY part) AS code,
                   CAST(sum(best.d) AS BIGINT) AS error
            FROM a{rounds} GROUP BY row
        ),
        h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
        FROM k JOIN c USING (row), h
    """


ORACLE["op13_vector_codes"] = _codes_sql()
