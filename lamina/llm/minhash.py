"""Near-duplicate documents by circulant MinHash, exact Jaccard verification and connected components.

A document is the set of its distinct shingles of n words (lower-cased A-Z; with fewer words, the whole sequence
is its one shingle). Shingles are hashed to 64 bits; their top bits name a place in a universe of 2**20. One
permutation scatters the places, a second one, shifted by 0, 1, 2, ... places, gives all coordinates of the
signature: coordinate k is the least value of the second permutation k places behind a shingle's place. Bands of
the signature name buckets.

Documents with equal sets are one class; only classes enter buckets. Links are found in two steps, neither of which
hands on pairs that are not links. First every member of a bucket is compared with ``CENTRES`` members of it, which
links large groups of copies by work in proportion to their size. Members of a bucket that are then connected need no
further comparison; in the buckets whose members are not all connected, those outside the bucket's largest group are
compared with each other and with the group, by pairs of blocks: a large bucket is many small groups of rows. Buckets
that are mostly one and the same group are taken as one.
Comparison is exact, on the sets of the hashes of all shingles of the whole texts: a link needs a similarity of at
least ``percent`` hundredths. What tasks exchange are these hashes, of classes that share a bucket.

Null and empty texts, and texts of white space, have no shingles and link with nothing. doc_id names a document: rows
that repeat one get a result each, and where their texts differ, what any of them links with is reached by all. Rows
without doc_id link with nothing; their component is null and they are kept. Texts may have any length; ties do not
occur, as the least doc_id is the component's name. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import at_end, by_batch, prepare, task, written
from .graph import components, redealt

UNIVERSE_BITS = 20
BANDS, ROWS = 32, 5
SIZE = BANDS * ROWS
#: Members that all others of a bucket are compared with, and members that one of them meets at a time.
CENTRES, HUB = 3, 256
#: Members of a block of a bucket, how many times wider blocks of large buckets get, and shingles and members that are
#: compared at a time.
BLOCK, WIDEST, COLUMNS, TILE = 128, 8, 4096, 512
_ODD = np.uint64(0x9E3779B97F4A7C15)


@cache
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and windows of the shifted one."""
    rng, n = np.random.default_rng(20), 1 << UNIVERSE_BITS
    scatter, values = rng.permutation(n), rng.permutation(n).astype(np.int32)
    return scatter, np.lib.stride_tricks.sliding_window_view(np.concatenate([values, values[:SIZE]]), SIZE)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Words whose hashes a worker remembers.
REMEMBERED = 150_000


class Words(dict):
    """64-bit hashes of words; forgets them when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = out = xxhash.xxh3_64_intdigest(word)
        return out


_WORDS = Words()
at_end(_WORDS.clear)
at_end(_permutations.cache_clear)


def shingles(text: str | None, n: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    words = (text or "").encode().lower().split()
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    if not len(h):
        return h
    n = min(n, len(h))
    out = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        out = _mix(out * _ODD + h[i : len(h) - n + 1 + i])
    return np.unique(_mix(out + np.uint64(n)))


def signature(found: np.ndarray) -> np.ndarray:
    """The circulant signature of a set that is not empty."""
    scatter, windows = _permutations()
    places = scatter[np.unique(found >> np.uint64(64 - UNIVERSE_BITS))]
    out = np.full(SIZE, np.iinfo(np.int32).max, np.int32)
    for i in range(0, len(places), 8192):
        np.minimum(out, windows[places[i : i + 8192]].min(axis=0), out=out)
    return out


def _band_keys(signatures: np.ndarray) -> np.ndarray:
    parts = signatures.reshape(-1, BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
    for i in range(ROWS):
        keys = _mix(keys * _ODD + parts[:, :, i])
    return keys.astype(np.int64)


def fingerprints(docs: DataFrame, n: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, hash, n_shingles, digest, bands): the text's hash, set size, 128-bit digest of the set, bucket keys."""

    def rows(batch):
        sets = [shingles(x, n) for x in batch.column("text").to_pylist()]
        keys = iter(_band_keys(np.stack([signature(s) for s in sets if len(s)])) if any(map(len, sets)) else ())
        return {
            "doc_id": batch.column("doc_id"), "hash": batch.column("hash"), "n_shingles": [len(s) for s in sets], "digest": [xxhash.xxh3_128_digest(s.tobytes()) for s in sets],
            "bands": pa.array([next(keys) if len(s) else [] for s in sets], pa.list_(pa.int64())),
        }

    return by_batch(_texts(docs, key, text), rows, "doc_id long, hash long, n_shingles long, digest binary, bands array<long>")


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.xxhash64(f"`{text}`").alias("hash"), F.col(f"`{text}`").alias("text"))


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets have a Jaccard similarity of at least percent hundredths."""
    if not len(a) or not len(b) or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def links(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Every pair of places whose sets are similar."""
    n = len(sets)
    if n <= 12:
        return [(i, j) for i in range(n) for j in range(i + 1, n) if similar(sets[i], sets[j], percent)]
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), sizes)
    _, token, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # a shingle of one member is in no intersection; the others are columns of zeros and ones, taken a few at a time
    column = np.cumsum(counts > 1) - 1
    met = counts[token] > 1
    owner, token = owner[met], column[token[met]]
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    out = []
    for top in range(0, n, TILE):
        both = np.zeros((min(TILE, n - top), n), np.float32)
        for at in range(0, int(token[-1]) + 1 if len(token) else 0, COLUMNS):
            a, b = np.searchsorted(token, (at, at + COLUMNS))
            part = np.zeros((n, COLUMNS), np.float32)
            part[owner[a:b], token[a:b] - at] = 1
            both += part[top : top + TILE] @ part.T
        both = both.astype(np.int64)
        i, j = np.nonzero(np.triu(100 * both >= percent * (sizes[top : top + TILE, None] + sizes[None, :] - both), top + 1))
        out += zip((i + top).tolist(), j.tolist(), strict=True)
    return out


def forest(pairs: list[tuple[int, int]]) -> dict[int, int]:
    """The least place that each linked place reaches."""
    up: dict[int, int] = {}

    def top(i: int) -> int:
        while up.setdefault(i, i) != i:
            up[i] = i = up[up[i]]
        return i

    for i, j in pairs:
        a, b = top(i), top(j)
        up[max(a, b)] = min(a, b)
    return {i: top(i) for i in up}


def _sets(members: DataFrame, classes: DataFrame, texts: DataFrame, n: int) -> DataFrame:
    """(cid, rep, grams): the shingle hashes of every class that has members, once each."""
    wanted = classes.join(redealt(members.select("cid").distinct(), "cid"), "cid").select("cid", "rep", F.col("hash").alias("rep hash"))
    rows = texts.join(redealt(wanted, "rep", "rep hash"), (F.col("doc_id") == F.col("rep")) & (F.col("hash") == F.col("rep hash")))
    schema = pa.schema([("cid", pa.int64()), ("rep", pa.int64()), ("grams", pa.binary())])

    def gather(batches):
        met = set()  # a row that is repeated is taken once in a task
        for batch in task(batches):
            fresh = [i for i, c in enumerate(batch.column("cid").to_pylist()) if c not in met and not met.add(c)]
            if fresh:
                part = batch.take(pa.array(fresh))
                grams = [shingles(x, n).tobytes() for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("cid"), part.column("rep"), pa.array(grams, pa.binary())], schema=schema)

    return written(rows.select("cid", "rep", "text").mapInArrow(gather, "cid long, rep long, grams binary").dropDuplicates(["cid"]), "sets")


_LINKS = "a long, b long, rep_a long, rep_b long"


def _links_batch(found: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found, strict=True) if found else ((),) * 4)], ["a", "b", "rep_a", "rep_b"])


def _star_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of buckets and the centres of these."""
    # the member that meets most others over all its buckets is the most typical one; further ones are drawn
    met_by = members.groupBy("cid").agg(F.sum("many").alias("meets"))
    ranked = members.join(redealt(met_by, "cid"), "cid")
    typical = F.max_by("cid", F.struct("meets", F.xxhash64("cid"))).alias("centre 0")
    centres = ranked.groupBy("bucket").agg(typical, *(F.min_by("cid", F.xxhash64("cid", F.lit(k))).alias(f"centre {k}") for k in range(1, CENTRES)))
    every = F.array_distinct(F.array(*(F.col(f"`centre {k}`") for k in range(CENTRES))))
    met = members.join(redealt(centres, "bucket"), "bucket")
    stars = met.select("cid", F.explode(F.when(F.col("many") > 2, every).otherwise(F.array(F.col("`centre 0`")))).alias("centre")).where("cid <> centre").distinct()
    stars = written(stars, "stars")
    sizes = stars.groupBy("centre").agg(F.ceil(F.count("*") / HUB).cast("int").alias("blocks"))
    dealt = stars.join(redealt(sizes, "centre"), "centre").select("cid", "centre", F.pmod(F.xxhash64("cid"), "blocks").cast("int").alias("block"), F.lit(1).alias("place"))
    heads = sizes.select(F.col("centre").alias("cid"), "centre", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.lit(0).alias("place"))
    rows = dealt.unionByName(heads).join(redealt(sets, "cid"), "cid").repartition("centre", "block").sortWithinPartitions("centre", "block", "place")

    def compare(batches):
        now, head, rep = None, None, None
        for batch in task(batches):
            out = []
            for centre, block, place, cid, own, grams in zip(*(batch.column(c).to_pylist() for c in ("centre", "block", "place", "cid", "rep", "grams")), strict=True):
                found = np.frombuffer(grams, np.uint64)
                if place == 0:
                    now, head, rep = (centre, block), found, own
                elif now != (centre, block):
                    raise ValueError(f"the centre {centre} is missing")
                elif similar(head, found, percent):
                    out.append((cid, centre, own, rep))
            yield _links_batch(out)

    return written(rows.select("centre", "block", "place", "cid", "rep", "grams").mapInArrow(compare, _LINKS), "links")


def _open(members: DataFrame, joined: DataFrame) -> DataFrame:
    """(bucket, merged, cid, own, minors, partners) of buckets whose members are not all connected.

    The main group of a bucket is its largest one. Buckets that are mostly the same main group, of which each holds a
    fair part, are merged under its name: their rows are met once, not once for each bucket. Members outside the main
    group have the first blocks, those of the group the others; blocks grow with the root of a bucket's size.
    """
    tagged = members.where("many > 2").join(redealt(joined, "id"), F.col("cid") == F.col("id"), "left").select("bucket", "cid", F.coalesce("component", "cid").alias("part"))
    parts = tagged.groupBy("bucket", "part").agg(F.count("*").alias("held"))
    largest = F.max_by("part", F.struct("held", F.xxhash64("part"))).alias("main")
    mains = parts.groupBy("bucket").agg(largest, F.max("held").alias("held"), F.sum("held").alias("rows"), F.count("*").alias("parts")).where("parts > 1")
    wholes = joined.groupBy("component").agg(F.count("*").alias("whole"))
    mains = mains.join(redealt(wholes, "component"), F.col("main") == F.col("component"), "left")
    mains = mains.select("bucket", "main", F.coalesce(F.expr("2 * held >= rows and 4 * held >= whole"), F.lit(False)).alias("merged"))
    named = F.when(F.col("merged"), F.col("main")).otherwise(F.col("bucket")).alias("bucket")
    rows = written(tagged.join(redealt(mains, "bucket"), "bucket").select(named, "merged", "cid", (F.col("part") != F.col("main")).alias("minor")).distinct(), "open")
    width = BLOCK * F.least(F.greatest(F.sqrt(F.count("*") / (4 * BLOCK)), F.lit(1.0)), F.lit(float(WIDEST)))
    blocks = lambda which: F.ceil(F.count_if(which) / width).cast("int")
    sizes = rows.groupBy("bucket", "merged").agg(blocks(F.col("minor")).alias("minors"), blocks(~F.col("minor")).alias("majors"))
    dealt = rows.join(redealt(sizes, "bucket", "merged"), ["bucket", "merged"])
    place = lambda n: F.pmod(F.xxhash64("cid"), n).cast("int")
    own = F.when(F.col("minor"), place("minors")).otherwise(F.col("minors") + place("majors"))
    return dealt.select("bucket", "merged", "cid", own.alias("own"), "minors", F.when(F.col("minor"), F.col("minors") + F.col("majors")).otherwise(F.col("minors")).alias("partners"))


def _block_links(opened: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between members of open buckets of which at least one stands outside the main group."""
    rows = opened.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("partners") - 1)))
    rows = rows.select("cid", "bucket", "merged", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).join(redealt(sets, "cid"), "cid")
    rows = rows.repartition("bucket", "merged", "i", "j").sortWithinPartitions("bucket", "merged", "i", "j", "cid")

    def compare(batches):
        now, held, found = None, [], []

        def result():
            joined = forest(links([np.frombuffer(g, np.uint64) for _, _, g in held], percent))
            return _links_batch([(held[i][0], held[k][0], held[i][1], held[k][1]) for i, k in joined.items()])

        for batch in task(batches):
            for *group, cid, rep, grams in zip(*(batch.column(c).to_pylist() for c in ("bucket", "merged", "i", "j", "cid", "rep", "grams")), strict=True):
                if group != now:
                    if len(held) > 1:
                        yield result()
                    now, held = group, []
                held.append((cid, rep, grams))
        if len(held) > 1:
            yield result()

    return rows.select("bucket", "merged", "i", "j", "cid", "rep", "grams").mapInArrow(compare, _LINKS)


def near_duplicates(docs: DataFrame, n: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs."""
    prepare(docs.sparkSession)
    prints = written(fingerprints(docs, n, key, text), "prints")
    named = prints.where("n_shingles > 0 and doc_id is not null")
    grouped = named.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.min_by("hash", "doc_id").alias("hash"), F.first("bands").alias("bands"))
    classes = written(grouped.withColumn("cid", F.monotonically_increasing_id()), "classes")
    buckets = classes.select("cid", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("many")).where("many > 1")
    members = written(buckets.join(redealt(shared, "bucket"), "bucket"), "members")
    sets = _sets(members, classes, _texts(docs, key, text), n)
    stars = _star_links(members, sets, percent)
    further = _block_links(_open(members, components(stars)), sets, percent)
    # a doc_id whose rows have different sets joins the classes of these
    several = named.groupBy("doc_id").agg(F.min(F.xxhash64("digest")).alias("low"), F.max(F.xxhash64("digest")).alias("high")).where("low <> high").select("doc_id")
    same = named.join(redealt(several, "doc_id"), "doc_id").select("doc_id", "digest").join(redealt(classes.select("digest", "rep"), "digest"), "digest").select("doc_id", "rep")
    edges = stars.unionByName(further).select("rep_a", "rep_b").union(same)
    found = components(edges, "rep_a", "rep_b")

    owners = classes.select("digest", "rep").join(redealt(found.withColumnRenamed("id", "rep"), "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("component"))
    rows = prints.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.when(F.col("doc_id").isNotNull(), F.col("digest"))).alias("own digest"))
    out = rows.join(redealt(owners, "digest"), F.col("own digest") == F.col("digest"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
