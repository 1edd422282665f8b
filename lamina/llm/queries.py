"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import attribution, bpe, labelled, media, minhash, mixing, quality, substrings, toxicity, vectors, warc
from .common import crc_remainder, read

#: Where the tokenizer's ranks are, and how it cuts texts.
RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
#: The score from which a document counts as toxic.
LEAST_TOXIC = 0.7


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on labelled rows of four folds in five; all rows are scored."""
    docs, held_out = read(spark, sf_dir, "documents"), crc_remainder(F.col("doc_id"), 5) == 0
    model = quality.fit(*labelled.sample(docs, read(spark, sf_dir, "labels"), "quality", held_out))
    return labelled.predictions(docs.select("doc_id", quality.scorer(spark, model)("text").alias("score")), held_out, 0.3)


def toxic_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    """A model fitted on labelled rows of two folds in three."""
    rows = labelled.sample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), "toxic", crc_remainder(F.col("doc_id"), 3) == 1)
    return toxicity.fit(*rows)


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two-word shingles, as this query's contract asks for."""
    return minhash.near_duplicates(read(spark, sf_dir, "documents").select("doc_id", "text"), n=2, percent=80)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attribution.token_counts(read(spark, sf_dir, "documents").select("doc_id", "text"), RANKS, PATTERN)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.drop_repeats(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return media.media_features(media.media_column(docs))


def op6_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("url")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, RANKS, PATTERN)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = toxicity.scorer(spark, toxic_model(spark, sf_dir))
    return labelled.predictions(read(spark, sf_dir, "documents").select("doc_id", score("text").alias("score")), crc_remainder(F.col("doc_id"), 3) == 1, LEAST_TOXIC)


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.linked(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), cosine=0.95)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(read(spark, sf_dir, "documents").select("doc_id", "text", "source"))


QUERIES = {f.__name__: f for f in (op1_quality, op2_minhash, op3_token_counts, op4_substring_dedup, op5_media_columns, op6_warc_chunks, op7_byte_bpe, op8_toxicity, op9_embedding_dedup, op10_mixing)}

#: Least identifiers that links reach, from (a, b) in both directions.
_PARTS = """reach AS (SELECT a AS id, b AS r FROM linked UNION SELECT reach.id, linked.b FROM reach JOIN linked ON reach.r = linked.a),
parts AS (SELECT id, min(r) AS least FROM reach GROUP BY id)"""

#: SQL for DuckDB, on whole tables. It expresses no models, draws, token merges, media streams or parts of lines; tests
#: hold these against brute force, round trips or held-out labels.
ORACLE_SQL: dict[str, str] = {
    "op2_minhash": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ 	-]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) < 2 THEN w ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS grams FROM words),
sized AS (SELECT doc_id, len(grams) AS n, grams FROM sets),
each_gram AS (SELECT doc_id, n, unnest(grams) AS gram FROM sized),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb, count(*) AS both_have FROM each_gram x JOIN each_gram y ON x.gram = y.gram AND x.doc_id < y.doc_id GROUP BY ALL),
pairs AS (SELECT a, b FROM shared WHERE 100 * both_have >= 80 * (na + nb - both_have)),
linked AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
{_PARTS}
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, least(doc_id, coalesce(least, doc_id)) AS component_id, doc_id = least(doc_id, coalesce(least, doc_id)) AS kept
FROM sized LEFT JOIN parts ON id = doc_id""",
    "op6_warc_chunks": """
WITH bodies AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
hashed AS (SELECT page_id, octet_length(encode(body)) AS size, sha1(body) AS h, min(page_id) OVER (PARTITION BY sha1(body)) AS first FROM bodies),
base32 AS (SELECT *, list_transform(range(0, 8), lambda i: CAST('0x' || h[5 * i + 1 : 5 * i + 5] AS BIGINT)) AS numbers FROM hashed)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((numbers[i // 4 + 1] >> (5 * (3 - i % 4))) & 31) + 1]), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM base32""",
    "op9_embedding_dedup": rf"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT x.vec_id AS a, y.vec_id AS b FROM vectors x JOIN vectors y ON x.vec_id < y.vec_id AND len(x.v) = len(y.v) WHERE list_cosine_similarity(x.v, y.v) >= 0.95),
linked AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
counted AS (SELECT a, count(*) AS n FROM linked GROUP BY a),
{_PARTS}
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id, vec_id = least(vec_id, coalesce(least, vec_id)) AS kept
FROM embeddings LEFT JOIN counted ON a = vec_id LEFT JOIN parts ON id = vec_id""",
}
