"""Large groups of near copies: what is compared again does not grow with the square of the group."""

import numpy as np
from pyspark.sql import functions as F

from lamina.llm import minhash


def opened(spark, n, buckets):
    """Open rows of n members that share all buckets; nine in ten are connected, the first of each ten is not."""
    ids = spark.range(n).select(F.col("id").alias("cid"))
    members = ids.crossJoin(spark.range(buckets).select(F.col("id").alias("bucket"))).withColumn("many", F.lit(n).cast("long"))
    joined = spark.range(n).where("id % 10 <> 0").select("id", F.lit(1).cast("long").alias("component"))
    return minhash._open(members, joined)


def test_buckets_of_one_group_are_met_once(spark):
    """Every pair with a member outside the main group has a block pair, and rows stay far below the group's square."""
    made = {}
    for n in (1000, 4000):
        rows = opened(spark, n, 20).collect()
        assert len(rows) == len({r.cid for r in rows}) == n and {(r.merged, r.bucket) for r in rows} == {(True, 1)}
        minors = rows[0].minors
        assert all((r.own < minors) == (r.cid % 10 == 0) and r.partners >= minors for r in rows)
        assert {r.partners for r in rows if r.own < minors} == {1 + max(r.own for r in rows)}
        made[n] = sum(r.partners for r in rows)
    assert made[1000] <= 3 * 1000 and made[4000] <= 8 * made[1000]


def test_the_main_group_is_the_largest(spark):
    """Whichever member a hash draws: a bucket of one large group and others has few members outside its main group."""
    ids = spark.range(600).select(F.col("id").alias("cid"))
    members = ids.crossJoin(spark.range(100, 140).select(F.col("id").alias("bucket"))).withColumn("many", F.lit(600).cast("long"))
    # the group has many further members elsewhere, so its buckets are not merged
    joined = spark.range(10_000).where("id >= 200").select("id", F.lit(200).cast("long").alias("component"))
    rows = minhash._open(members, joined).groupBy("bucket", "merged").agg(F.count_if(F.col("own") < F.col("minors")).alias("outside")).collect()
    assert len(rows) == 40 and {(r.merged, r.outside) for r in rows} == {(False, 200)}


def test_links_by_tiles_equal_those_of_pairs(monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 7)
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 60).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[rng.random(60) < 0.93], rng.integers(0, 2**63, 2).astype(np.uint64)])) for _ in range(40)]
    pairs = [(i, j) for i in range(40) for j in range(i + 1, 40) if minhash.similar(sets[i], sets[j], 80)]
    assert pairs and sorted(minhash.links(sets, 80)) == pairs
