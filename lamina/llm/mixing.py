"""Mixing sources to target weights by the cube method.

Every source has a target number of words. A document is taken a whole number of times: the whole part of
target / size of its source always, and once more with the fractional part as its inclusion probability. The
cube method makes these draws: in a block of documents of one source it moves the undecided probabilities
along the null space of the constraints (documents taken, words taken) until one of them is 0 or 1. At most two documents of a block stay undecided; those of all blocks of a source are blocks of the next level, and
when a source has one block left, its last two undecided documents are landed by giving up the document count
first and the word count last. Larger documents come first, so that what is landed is small.

Blocks hold about ``BLOCK`` documents by a hash of doc_id, whatever the size of the source. Rows that repeat a
document are counted first and dealt in chunks of at most ``CHUNK``, so a document of many rows is spread over blocks
like others. Draws are seeded by source, level and block, and documents are ordered by size and a hash of doc_id, so
reruns agree. Sources stay in a table, whatever their number.

A null text has size 0, a null source is a source of its own, ranked last; a null doc_id names a document like any
other. A source without words has target 0. Texts may have any length. Repeated rows are drawn one by one. An empty
table gives an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import prepare, saved, word_count
from .graph import redealt

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2
BLOCK, CHUNK = 4096, 512


def targets(sources: DataFrame) -> DataFrame:
    """sources (source, source_size) with rank, weight and target: share of all by weight, none above most times its size.

    In order of size by weight, sources stop at their bound until what is left, dealt by weight, keeps below the bound
    of the next one; it is then dealt to that one and all behind it.
    """
    every = math.lcm(*WEIGHTS)
    by_rank = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("rank") % len(WEIGHTS) + 1)
    ranked = sources.withColumn("rank", F.row_number().over(W.orderBy(F.col("source").isNull(), "source")) - 1).withColumn("weight", by_rank(WEIGHTS))
    order = W.orderBy("by weight", "rank")
    before, behind = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    ranked = ranked.withColumn("by weight", F.col("source_size") * by_rank([every // w for w in WEIGHTS]))
    total = F.sum("source_size").over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    left = F.lit(SHARE) * total - MOST * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    filled = ranked.withColumn("left", left).withColumn("weights", F.sum("weight").over(behind))
    free = MOST * F.col("source_size") * F.col("weights") >= F.col("left") * F.col("weight")
    first = F.first(F.when(free, F.struct("left", "weights")), ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0))
    dealt = filled.withColumn("dealt", first)
    target = F.when(F.col("dealt").isNull(), MOST * F.col("source_size")).otherwise(F.col("dealt.left") * F.col("weight") / F.col("dealt.weights"))
    return dealt.withColumn("target", target.cast("double")).drop("by weight", "left", "weights", "dealt")


def flight(chance: np.ndarray, size: np.ndarray, rng: np.random.Generator, land: bool) -> np.ndarray:
    """Chances moved to 0 or 1; at most two stay between, none if they are to land.

    Each move takes the direction of the largest undecided document, projected onto the null space of both
    constraints, so that all undecided documents share what balances it.
    """
    p, s = chance.astype(float), size.astype(float)
    open_ = np.flatnonzero((p > 0) & (p < 1))

    def move(units: np.ndarray, way: np.ndarray) -> None:
        q = p[units]
        with np.errstate(divide="ignore", invalid="ignore"):
            room_up = np.where(way > 0, (1 - q) / way, np.where(way < 0, q / -way, np.inf))
            room_down = np.where(way > 0, q / way, np.where(way < 0, (1 - q) / -way, np.inf))
        up, down = room_up.min(), room_down.min()
        rises = rng.random() * (up + down) < down
        q = q + way * (up if rises else -down)
        hit = (room_up if rises else room_down).argmin()
        q[hit] = round(q[hit])
        p[units] = np.where(q < 1e-9, 0.0, np.where(q > 1 - 1e-9, 1.0, q))

    while len(open_) > 2:
        a = s[open_] - s[open_].mean()
        spread = a @ a
        for i in (0, len(open_) - 1, len(open_) // 2):
            way = -1.0 / len(open_) - (a * (a[i] / spread) if spread > 0 else 0.0) * np.ones(len(open_))
            way[i] += 1
            if way[i] > 1e-6:
                break
        way[np.abs(way) < 1e-12] = 0.0
        move(open_, way)
        open_ = open_[(p[open_] > 0) & (p[open_] < 1)]
    while land and len(open_):
        way = np.ones(1)
        if len(open_) == 2:
            a, b = s[open_]
            way = np.array([1.0, -1.0]) if a == b else np.array([b, -a]) / max(a, b)
        move(open_, way)
        open_ = open_[(p[open_] > 0) & (p[open_] < 1)]
    return p


def _level(rows: DataFrame, names: list[str], level: int, land: bool) -> DataFrame:
    """One flight in every block of every source; rows of several documents become one for each."""

    def fly(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "order", *names], ascending=[False, *[True] * (1 + len(names))], ignore_index=True)
        group = group.loc[group.index.repeat(group["many"])].assign(many=1).reset_index(drop=True)
        rng = np.random.default_rng([level, int(key[0]), int(key[1])])
        return group.assign(chance=flight(group.chance.to_numpy(), group["size"].to_numpy(), rng, land))

    return saved(rows.groupBy("rank", "block").applyInPandas(fly, rows.schema))


def drawn(sized: DataFrame, names: list[str]) -> DataFrame:
    """(names, size, source_size, target, copies) for every row of sized (names, source, size).

    names must hold no numbers with nulls, as these travel through pandas.
    """
    prepare(sized.sparkSession)
    crowds = saved(sized.groupBy(*names, "source", "size").agg(F.count("*").alias("n")))
    sources = crowds.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"))
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(MOST)))).otherwise(0.0)
    plan = targets(sources).withColumn("rate", rate).withColumn("copies", F.floor("rate").cast("int")).withColumn("chance", F.col("rate") - F.col("copies"))
    plan = saved(plan.select(F.col("source").alias("its source"), "rank", "source_size", "target", "copies", "chance", "blocks"))
    chunk = min(CHUNK, BLOCK)
    dealt = crowds.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / chunk).cast("int")))).withColumn("many", F.least(F.col("n") - F.col("chunk") * chunk, F.lit(chunk)).cast("int"))
    now = dealt.join(redealt(plan, "its source"), F.col("source").eqNullSafe(F.col("its source"))).drop("source", "its source", "n")
    now = now.withColumn("order", F.xxhash64(*names, "size")).withColumnRenamed("chunk", "block")
    blocks, level, done = plan.agg(F.max("blocks")).first()[0] or 1, 0, []
    while True:
        # the chunk, and later the block that a document comes from, tell apart rows that repeat it
        now = _level(now.withColumn("block", F.pmod(F.xxhash64(*names, "block", F.lit(level)), "blocks").cast("int")), names, level, blocks == 1)
        if blocks == 1:
            done.append(now)
            break
        # a source whose blocks were one has up to two documents left, which the last level lands
        done.append(now.where("chance in (0.0, 1.0)"))
        now = now.where("chance not in (0.0, 1.0)").withColumn("blocks", F.ceil(F.col("blocks") * 2 / BLOCK).cast("int"))
        level, blocks = level + 1, -(-blocks * 2 // BLOCK)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(*names, "size", "source_size", "target", (F.col("copies") + F.col("chance").cast("int")).alias("copies"))


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken) for every row of docs."""
    # identifiers travel as text: pandas has no integers beside nulls
    sized = docs.select(F.col(f"`{key}`").cast("long").cast("string").alias("doc_id"), F.col(f"`{source}`").cast("string").alias("source"), word_count(F.col(f"`{text}`")).alias("size"))
    out = drawn(sized, ["doc_id"])
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))
