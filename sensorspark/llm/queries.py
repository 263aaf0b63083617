"""Thin queries over the driver tables, one per operator, with SQL twins where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorspark.llm import (
    bpe,
    collocations,
    licenses,
    mixing,
    pii,
    pu_quality,
    quality_rules,
    search,
    simhash,
    token_files,
    toxicity,
    warc,
    whitening,
)
from sensorspark.plans.shared import new_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Vocabulary of the token queries; operators take any path.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op2_simhash_dedup")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.classes(table(spark, folder, "documents"))
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


_OP7 = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
w AS (SELECT doc_id, x, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS words, string_split(x, chr(10)) AS raw FROM t),
m AS (SELECT doc_id, x, words, len(words) AS n_words,
             coalesce(list_sum(list_transform(words, lambda v: length(v))), 0) AS word_chars,
             len(regexp_extract_all(x, '[#*$%&|<>]')) AS n_symbols,
             list_filter(raw, lambda v: regexp_matches(v, '[^\x20\x09-\x0D]')) AS lines FROM w),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, list_slice(words, i, i + 4)) AS c
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM m)),
r AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
      FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM g WHERE c > 1) GROUP BY doc_id),
a AS (SELECT m.doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols,
             len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
             len(lines) AS n_lines,
             len(list_filter(words, lambda v: regexp_matches(v, '[A-Za-z]|[^\x00-\x7F]'))) AS n_letter_words,
             len(list_filter(words, lambda v: contains(v, '!'))) AS n_shout_words,
             len(regexp_extract_all(x, '[A-Za-z]')) AS n_letters, len(regexp_extract_all(x, '[A-Z]')) AS n_upper
      FROM m LEFT JOIN r USING (doc_id)),
f AS (SELECT *, n_words < 10 AS f0, 100 * n_repeat_words > 20 * n_words AS f1, 10 * n_symbols > n_words AS f2,
             word_chars < 2 * n_words OR word_chars > 15 * n_words AS f3, 100 * n_dup_lines > 30 * n_lines AS f4,
             100 * n_letter_words < 80 * n_words AS f5, 100 * n_shout_words > 30 * n_words AS f6,
             100 * n_upper > 60 * n_letters AS f7 FROM a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       f0::BIGINT + 2 * f1::BIGINT + 4 * f2::BIGINT + 8 * f3::BIGINT + 16 * f4::BIGINT + 32 * f5::BIGINT
           + 64 * f6::BIGINT + 128 * f7::BIGINT AS fail_bits,
       f0 OR f1 AS base_failed,
       NOT (f0 OR f1 OR f2 OR f5 OR f6 OR f3::INT + f4::INT + f7::INT > 1) AS kept
FROM f
"""


@query("op7_quality_rules", _OP7)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    entries = quality_rules.ledger(table(spark, folder, "documents"))
    return quality_rules.apply_policy(entries, quality_rules.POLICIES["v2"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "fail_bits", "base_failed", "kept")


@query("op9_bpe_stream")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(table(spark, folder, "documents"), TOKENIZER, round_trip=True).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op10_pii_spans")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.detect(table(spark, folder, "documents"))
    count = lambda kind: F.size(F.filter("strict", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in pii.KINDS], F.sha2(pii.written(F.col("strict")), 256).alias("base_sha256"),
                        pii.written(F.col("spans")).alias("spans"))


# Shares of the sources: every fifth is wanted five times as often as the scarcest; the rest shares one part.
SHARES = {f"src{i}": float(1 + i % 5) for i in range(20)} | {mixing.REST: 1.0}

_OP4 = """
WITH d AS (SELECT *, CASE WHEN regexp_full_match(coalesce(source, ''), 'src(1?[0-9])') THEN source ELSE '*' END AS b FROM documents),
n AS (SELECT b, count(*) AS n, CASE WHEN b = '*' THEN 1.0 ELSE 1 + CAST(substr(b, 4) AS INT) % 5 END::DOUBLE AS w FROM d GROUP BY b),
r AS (SELECT b, (SELECT sum(n) FROM n) * w / (SELECT sum(w) FROM n) / n AS rate FROM n),
p AS (SELECT b, k, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY b ORDER BY k) AS below
      FROM (SELECT b, rate, unnest(range(0, CAST(rate + 20 * sqrt(rate) + 40 AS BIGINT))) AS k FROM r)),
q AS (SELECT b, list(below ORDER BY k) AS cdf FROM p GROUP BY b),
c AS (SELECT d.*, len(list_filter(q.cdf, lambda x: x <= CAST('0x' || substr(md5('17|' || doc_id || '|' || coalesce(text, '')), 1, 13) AS BIGINT) / 4503599627370496.0)) AS copies
      FROM d JOIN q USING (b)),
e AS (SELECT doc_id, text, lang, source, n_chars, unnest(range(0, copies)) AS copy FROM c)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INT) AS copy,
       CAST('0x' || substr(md5('18|' || doc_id || '|' || coalesce(text, '') || '|' || copy), 1, 13) AS BIGINT) / 4503599627370496.0 AS order_key FROM e
"""


@query("op4_poisson_mix", _OP4)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents"), SHARES)


@query("op6_pu_quality")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    held_out = pu_quality.held_out(F.col("doc_id"))
    positives = table(spark, folder, "labels").filter((F.col("quality") == 1) & ~held_out)
    scored = pu_quality.score_quality(table(spark, folder, "documents"), positives)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query("op1_toxicity_chain")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    scored = toxicity.score_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))
    flag = lambda c: (F.col(f"p_{c}") >= 0.5).cast("int").alias(c)
    return scored.select("doc_id", *[flag(c) for c in ("toxic", "severe", "persistent")], "p_toxic", "p_severe", "p_persistent")


@query("op8_license_scan")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.scan(table(spark, folder, "documents"))
    joined = lambda labels: F.array_join(labels, ",")
    method = F.transform("found", lambda f: f["label"])
    score = F.when(F.size("found") > 0, F.array_max(F.transform("found", lambda f: f["score"]))).otherwise(
        F.when(F.size("places") > 0, 0.5).otherwise(0.0))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("bigint").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["start"])).cast("bigint").alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["start"])).cast("bigint").alias("last_word"),
        joined(F.col("base_labels")).alias("base_labels"),
        joined(F.array_sort(F.array_distinct(F.concat("base_labels", method)))).alias("labels"), score.alias("score"))


@query("op3_warc_derivatives")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return warc.derive(warc.responses(table(spark, folder, "pages")))


_OP5 = r"""
WITH t AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\pL\pN]+'), lambda w: w <> '') AS ws FROM documents),
s AS (SELECT count(*)::DOUBLE AS n, sum(len(ws)) / count(*)::DOUBLE AS mean FROM t),
p AS (SELECT doc_id, w, count(*) AS tf, any_value(dl) AS dl FROM (SELECT doc_id, unnest(ws) AS w, len(ws) AS dl FROM t) GROUP BY doc_id, w),
f AS (SELECT w, ln(1 + (n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM p, s GROUP BY w, n),
c AS (SELECT q.doc_id AS query_id, d.doc_id,
             sum(round((q.tf * idf) * (d.tf * 2.2 / (d.tf + 1.2 * (0.25 + 0.75 * (d.dl / mean)))) * 1073741824)) / 1073741824 AS score
      FROM p q JOIN f USING (w) JOIN p d ON d.w = q.w, s WHERE q.doc_id % 100 = 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM c)
SELECT query_id, CAST(rank AS INT) AS rank, doc_id, round(score, 6) AS score FROM r WHERE rank <= 10
"""


@query("op5_bm25_top_k", _OP5)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = search.top_k(docs, docs.filter("doc_id % 100 = 0"))
    return found.select("query_id", "rank", "doc_id", F.round("score", 6).alias("score"))


@query("op11_whitening")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whiten(table(spark, folder, "embeddings"))
    return found.select("vec_id", "component", "n", F.col("deviation").try_cast("bigint").alias("deviation"), "whitened", "explained",
                        "identity_error")


@query("op12_token_files")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "token-files")
    token_files.write(table(spark, folder, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.read(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


_OP13 = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
o AS (SELECT lang, unnest(range(1, len(ws) + 1)) AS i, ws FROM w),
g AS (SELECT lang, k, ws[i:i + k - 1] AS words FROM o, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(ws)),
f AS MATERIALIZED (SELECT lang, k, words, array_to_string(words, ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, sum(f) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT * FROM f WHERE k > 1 AND f >= 30),
s AS (SELECT lang, array_to_string(words[i:i + m - 1], ' ') AS phrase, max(f) AS longer
      FROM c, (SELECT unnest([1, 2, 3]) AS i), (SELECT unnest([2, 3]) AS m) WHERE m < k AND i + m - 1 <= k GROUP BY ALL),
h AS (SELECT c.* FROM c LEFT JOIN s USING (lang, phrase) WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * f::HUGEINT),
y AS (SELECT h.*, j, array_to_string(words[1:j], ' ') AS head, array_to_string(words[j + 1:], ' ') AS tail
      FROM h, (SELECT unnest([1, 2, 3]) AS j) WHERE j < k),
x AS (SELECT y.lang, y.phrase, y.f AS a, j, u.f AS l, v.f AS r, (2000000 * y.f::HUGEINT) // (u.f + v.f) AS score
      FROM y JOIN f u ON u.lang = y.lang AND u.phrase = y.head JOIN f v ON v.lang = y.lang AND v.phrase = y.tail),
b AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM b)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM r JOIN n USING (lang) WHERE rank <= 2000
"""


@query("op13_collocations", _OP13)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.mine(table(spark, folder, "documents"))
