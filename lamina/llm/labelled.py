"""Bounded samples of labelled documents, on which the classifiers are fitted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare

#: Labelled documents of each class that a classifier is fitted on at most, and their greatest length in characters.
PER_CLASS, LONGEST = 1500, 20_000


def sample(docs: DataFrame, labels: DataFrame, label: str, held_out: Column, per_class: int = PER_CLASS, longest: int = LONGEST) -> tuple[list[tuple[str, int]], float]:
    """([(text, label)], share of label 1) of labelled documents outside the held-out fold.

    A document labelled twice counts with the greater label, rows without doc_id or label not at all. The documents
    of a class are, of those that are not too long, those of least hash of doc_id; of rows that repeat a doc_id, the
    text of least hash. The share is that of all labels outside the fold.
    """
    prepare(docs.sparkSession)
    own = labels.where(~held_out & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label")).where("label in (0, 1)")
    counts = {r["label"]: r["count"] for r in own.groupBy("label").count().collect()}
    if not counts:
        return [], 0.0
    short = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= longest)
    # identifiers and hashes first, as texts travel far: a row for each document, then the first ones of each class
    names = short.select("doc_id", F.xxhash64("text").alias("mark")).groupBy("doc_id").agg(F.min("mark").alias("mark")).join(own, "doc_id")
    picked = [r for k in (0, 1) for r in names.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()]
    chosen = F.broadcast(docs.sparkSession.createDataFrame([(r["doc_id"], r["mark"], r["label"]) for r in picked], "doc_id long, mark long, label int"))  # at most two classes of per_class rows
    rows = short.withColumn("mark", F.xxhash64("text")).join(chosen, ["doc_id", "mark"]).dropDuplicates(["doc_id"]).collect()
    # the order of rows must not matter to what is fitted
    rows = sorted(((r["doc_id"], r["text"], r["label"]) for r in rows), key=lambda r: (hash((r[0], 1)) & 0xFFFF, r))
    return [(text, y) for _, text, y in rows], counts.get(1, 0) / sum(counts.values())


def predictions(scores: DataFrame, held_out: Column, least: float) -> DataFrame:
    """(doc_id, held_out, score, predicted) from (doc_id, score)."""
    held = F.coalesce(held_out, F.lit(False)).alias("held_out")
    return scores.select("doc_id", held, "score", (F.col("score") >= least).cast("int").alias("predicted"))
