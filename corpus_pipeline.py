"""The corpus pipeline: documents to token ids in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the
next one's docs. All but the last return the columns of documents; other columns are handed on.

1. toxicity: documents with a score of at least 0.7 go.
2. minhash: of each group of near copies (five-word shingles, similarity of 0.8 or more) the least doc_id stays.
3. substrings: repeated lines and passages go; a document of which nothing is left goes.
4. mixing: every document is taken as often as the mix says, up to twice; a document taken twice is two rows.
5. bpe: token ids, with the digest of what they decode to.

Rows that repeat a doc_id are one document to stages 2 and 3, and are drawn one by one in stage 4; of rows that are
alike in doc_id, source and text as many copies of one go on as are drawn of all. Rows without doc_id stay in stages 2 and 3, but lose
repeats inside their own texts. Null, empty and white texts pass stages 1 to 3, and are drawn as documents of no words.
Texts may have any length. Ties are decided by doc_id, then by hashes of the rows, so reruns agree. An empty table
passes all stages; columns besides those of documents are handed on, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lamina.llm import bpe, minhash, mixing, substrings, toxicity
from lamina.llm.common import read, shared_folder, word_count
from lamina.llm.graph import redealt
from lamina.llm.queries import LEAST_TOXIC, PATTERN, RANKS, toxic_model


#: Copies of one row that a task writes.
SOME = 1000


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    score = toxicity.scorer(spark, toxic_model(spark, sf_dir))
    return docs.where(score("text") < LEAST_TOXIC)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = minhash.near_duplicates(docs).where("not kept").select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = substrings.drop_repeats(docs).where("size(removed_starts) = 0 or text rlike '\\\\S'")
    return left.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(f"`{c}`") for c in docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # other columns travel in one, so that their names meet none of those used here
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), *(F.xxhash64(F.lit(i), "doc_id", "source", "text").alias(f"name{i}") for i in (0, 1)))
    name = ["name0", "name1"]
    drawn = mixing.drawn(packed.select(*name, "source", "size"), name).groupBy(*name).agg(F.sum("copies").alias("copies"), F.count("*").alias("rows")).where("copies > 0")
    joined = packed.select(*name, "row").join(redealt(drawn, *name), name)
    single = joined.where("rows = 1").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row")
    # rows that are alike are one row, taken as often as all of them are, some copies in each task
    alike = joined.where("rows > 1").groupBy(*name).agg(F.first("row").alias("row"), F.first("copies").alias("copies"))
    parts = alike.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / SOME)))).repartition(*name, "part")
    several = parts.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(SOME).cast("long"), F.col("copies") - F.col("part") * SOME)))).select("row")
    return single.unionByName(several).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.round_trip(docs, RANKS, PATTERN, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash", drop_near_copies),
    ("substrings", drop_repeats),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: SQL expresses neither the classifier nor the draws; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder."""
    docs = read(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
