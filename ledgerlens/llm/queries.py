"""The registered queries of this subpackage, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import (
    bpe,
    collocations,
    exact_dedup,
    html_extract,
    language_id,
    maxscore,
    mixing,
    packing,
    periodic_runs,
    quality,
    sharding,
    simhash,
    token_count,
)
from ledgerlens.llm.batches import held_out

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
TOKEN_LIMIT = 1024
SHARDS = 8
TOP = 5
QUALITY_FOLDS, QUALITY_HELD = 5, 0
LANG_FOLDS, LANG_HELD = 3, 1


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return html_extract.extract(pages).select("page_id", "url", "text", "n_chars")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    held = held_out("doc_id", QUALITY_FOLDS, QUALITY_HELD)
    model = quality.train(docs, labels, ~held)
    return quality.score(docs, model).select(
        "doc_id", held.alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.round_trip_digests(docs, public_tokenizers.path(BYTE_BPE))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays of its group of equal texts."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return token_count.count_tokens(docs, public_tokenizers.path(BYTE_BPE)).withColumn(
        "over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard and slot; the law is ``rows``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, sf_dir, "documents", "doc_id", "text").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return sharding.shard_rows(docs, ["doc_id", "size", "text_crc32"], shards=SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op7_maxscore_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors for every 50th vector."""
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding").filter(maxscore.usable(F.col("embedding")))
    vectors = rows.select("vec_id", maxscore.quantised(F.col("embedding")).alias("vector"))
    return maxscore.top_k(vectors, vectors.filter("vec_id % 50 = 0"), TOP)


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and the component of fingerprints it belongs to."""
    groups = simhash.near_groups(table(spark, sf_dir, "documents", "doc_id", "text"))
    digits = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held = held_out("doc_id", LANG_FOLDS, LANG_HELD)
    model = language_id.train(docs, ~held)
    return language_id.predict(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of every document, packed."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(docs, public_tokenizers.path(WORD_BPE))


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words that the mix takes of every document."""
    return mixing.taken(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def planted_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """Makes a tail of every tenth document (by the CRC of its id) periodic; null ids are left as they are."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    base = words[a:a + 1 + (n - a) // (3 + g % 8)]
    return words[:a] + (base * (-(-(n - a) // len(base))))[:n - a]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic runs, the greatest of them and digests."""
    return periodic_runs.run_digests(table(spark, sf_dir, "documents", "doc_id", "text"), prepare=planted_period)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every language's best phrases."""
    return collocations.collocations(table(spark, sf_dir, "documents", "text", "lang"))


QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_quality_classifier, op3_bpe_round_trip, op4_exact_dedup, op5_token_counts, op6_sharding,
    op7_maxscore_search, op8_simhash_near_dedup, op9_language_id, op10_packing,
    op11_source_mixing, op12_periodic_runs, op13_collocations)}

ORACLE_SQL = {
    "op4_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  (doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY norm))
    AND row_number() OVER (PARTITION BY norm, doc_id) = 1 AS kept,
  sha256(norm) AS text_sha256
FROM n""",
    "op7_maxscore_search": """
WITH v AS (
  SELECT vec_id, min(list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    list_sum(list_transform(list_zip(q.vec, c.vec), lambda z: coalesce(z[1] * z[2], 0)))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, n::INTEGER AS rank, vec_id, score FROM r WHERE n <= 5""",
    "op13_collocations": r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS s FROM documents WHERE text IS NOT NULL),
p AS (SELECT lang, unnest(regexp_split_to_array(s, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (
  SELECT lang, k, unnest(list_transform(generate_series(1, len(ws) - k + 1), lambda i: ws[i:i + k - 1])) AS words
  FROM w, (SELECT unnest(generate_series(1, 5)) AS k) WHERE len(ws) >= k),
c AS (SELECT lang, k, words, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
inner_parts AS (
  SELECT lang, unnest([words[1:k - 1], words[2:k]]) AS words, f FROM c WHERE k > 2),
wider AS (SELECT lang, words, max(f) AS f FROM inner_parts GROUP BY ALL),
kept AS (
  SELECT c.* FROM c LEFT JOIN wider USING (lang, words) WHERE k > 1 AND (wider.f IS NULL OR wider.f < c.f)),
cuts AS (
  SELECT lang, words, k, f AS a, unnest(generate_series(1, k - 1)) AS cut_at FROM kept),
scored AS (
  SELECT cuts.lang, array_to_string(cuts.words, ' ') AS phrase, a, l.f AS l, r.f AS r, n.n, cut_at,
    ((1000::HUGEINT * a * n.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
  FROM cuts JOIN c l ON l.lang = cuts.lang AND l.words = cuts.words[1:cut_at]
  JOIN c r ON r.lang = cuts.lang AND r.words = cuts.words[cut_at + 1:cuts.k] JOIN n ON n.lang = cuts.lang),
worst AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut_at) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM worst QUALIFY rank <= 2000""",
}
