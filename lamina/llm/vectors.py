"""Near-duplicate vectors by p-stable Euclidean hashing with exact cosine verification.

Vectors are normalised; on the unit sphere a cosine of at least c is a Euclidean distance of at most
sqrt(2 - 2c). A hash is a Gaussian projection, shifted and cut into steps of width ``WIDTH``; a table's bucket is
the tuple of its hashes. The number of hashes follows the number of vectors, so that unrelated ones rarely meet,
and the number of tables follows from that and the recall asked for at the threshold itself; above it, it is higher.

Equal vectors are one class, which their least vec_id represents with their number as its weight. Buckets of one
class end there, and of buckets with the same members in several tables the first stands for all. A bucket's members
are dealt into blocks by a hash, and every pair of blocks is one group of rows, so a hot bucket is many small tasks.
Groups are compared many at a time; each linked pair is counted in the first table in which it meets, and a group
hands on a spanning forest of its links, never the pairs themselves.

Projections and vectors are rounded to integers for hashing, which makes their sums exact and the bucket of a
vector the same wherever it is computed; cosines are computed in double precision from the stored components.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing; vectors of different
lengths never link. vec_id names a vector: rows that repeat one count once, and each gets its result; of different
vectors under one vec_id, that of least digest counts, the others link with nothing and are components of their own.
Rows without vec_id link with nothing; their component is null and they are kept. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import math
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import at_end, by_batch, prepare, saved, task, written
from .graph import components, redealt

WIDTH = 2.0
RECALL = 0.995
BLOCK = 256
#: How many unrelated vectors may share a bucket with one, on average.
STRANGERS = 1 / 32


def collision(distance: float, width: float = WIDTH) -> float:
    """The probability that a hash puts two points at a distance into one step."""
    x = width / distance
    return math.erf(x / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * x) * (1 - math.exp(-x * x / 2))


def plan(n: int, cosine: float, recall: float = RECALL) -> tuple[int, int]:
    """(hashes a table, tables) for n vectors."""
    near, far = collision(math.sqrt(max(2 - 2 * cosine, 1e-9))), collision(math.sqrt(2))
    k = max(1, math.ceil(math.log(max(n, 2) / STRANGERS) / -math.log(far)))
    return k, max(1, math.ceil(math.log(1 - recall) / math.log1p(-(near**k))))


@cache
def _projections(dim: int, k: int, tables: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([9, dim, k, tables])
    return np.rint(rng.standard_normal((dim, k * tables)) * 2**10), np.rint(rng.random(k * tables) * WIDTH * 2**25)


at_end(_projections.cache_clear)


def buckets(unit: np.ndarray, k: int, tables: int) -> np.ndarray:
    """The bucket key of each vector in each table."""
    project, shift = _projections(unit.shape[1], k, tables)
    steps = np.floor((np.rint(unit * 2**15) @ project + shift) / (WIDTH * 2**25)).astype(np.int64).reshape(len(unit), tables, k)
    keys = np.broadcast_to(np.arange(tables, dtype=np.uint64) + np.uint64(unit.shape[1] << 32), steps.shape[:2])
    for i in range(k):
        keys = (keys ^ steps[:, :, i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        keys = keys ^ (keys >> np.uint64(29))
    return keys.astype(np.int64)


def normalised(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrices(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors) for each length of the lists in a column; null components are NaN, empty lists left out."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    flat, starts = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.cumsum(sizes) - sizes
    return [(at, flat[starts[at][:, None] + np.arange(n)]) for n in np.unique(sizes).tolist() if n for at in [np.flatnonzero(sizes == n)]]


def _digests(rows: DataFrame) -> DataFrame:
    """(vec_id, hi, lo, embedding); the digest of a vector without direction is null."""

    def digest(batch):
        pairs, ok = np.zeros((batch.num_rows, 2), np.int64), np.zeros(batch.num_rows, bool)
        for at, many in _matrices(batch.column("embedding")):
            good = np.isfinite(many).all(axis=1) & many.any(axis=1)
            for i, v in zip(at[good].tolist(), many[good] + 0.0, strict=True):
                pairs[i] = np.frombuffer(xxhash.xxh3_128_digest(v.tobytes()), "<i8")
            ok[at[good]] = True
        hi, lo = (pa.array(pairs[:, c], mask=~ok) for c in (0, 1))
        return {"vec_id": batch.column("vec_id"), "hi": hi, "lo": lo, "embedding": batch.column("embedding")}

    return by_batch(rows, digest, "vec_id long, hi long, lo long, embedding array<double>")


def linked(vectors: DataFrame, cosine: float = 0.95, recall: float = RECALL, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of vectors."""
    prepare(vectors.sparkSession)
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    marked = _digests(rows)
    single = marked.where("hi is not null and vec_id is not null").groupBy("vec_id").agg(F.min(F.struct("hi", "lo", "embedding")).alias("d")).select("vec_id", "d.*")
    classes = saved(single.groupBy("hi", "lo").agg(F.min("vec_id").alias("rep"), F.count("*").alias("weight"), F.first("embedding").alias("embedding")))
    k, tables = plan(classes.count(), cosine, recall)
    points = classes.select(F.col("rep").alias("vec_id"), "weight", "embedding")

    def place(batch):
        ids, keys = batch.column("vec_id").to_numpy(), np.zeros((batch.num_rows, tables), np.int64)
        for at, many in _matrices(batch.column("embedding")):
            keys[at] = buckets(normalised(many), k, tables)
        yield {"vec_id": np.repeat(ids, tables), "slot": np.tile(np.arange(tables, dtype=np.int32), len(ids)), "bucket": keys.ravel()}

    placed = by_batch(points.select("vec_id", "embedding"), place, "vec_id long, slot int, bucket long")
    shared = placed.groupBy("slot", "bucket").agg(F.count("*").alias("many")).where("many > 1")
    met = written(placed.join(redealt(shared, "slot", "bucket"), ["slot", "bucket"]), "met")
    # of buckets with the same members the first one stands for all: a pair that meets there first is in it
    crowds = met.groupBy("slot", "bucket").agg(F.first("many").alias("many"), *(F.bit_xor(F.xxhash64("vec_id", F.lit(i))).alias(f"mark{i}") for i in (0, 1)))
    chosen = crowds.groupBy("many", "mark0", "mark1").agg(F.min("slot").alias("slot"), F.min_by("bucket", "slot").alias("bucket")).select("slot", "bucket")
    members = met.join(redealt(chosen, "slot", "bucket"), ["slot", "bucket"]).withColumn("blocks", F.ceil(F.col("many") / BLOCK).cast("int"))
    members = members.withColumn("own", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int"))
    pairs = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.select("vec_id", "slot", "bucket", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    groups = pairs.join(points, "vec_id").repartition("slot", "bucket", "i", "j").sortWithinPartitions("slot", "bucket", "i", "j", "vec_id")
    schema = pa.schema([("vec_id", pa.int64()), ("links", pa.int64()), ("hub", pa.int64())])

    def compare(batches):
        held = None
        for batch in chain(task(batches), [None]):
            rows = held if batch is None else pa.Table.from_batches([batch] if held is None else [*held.to_batches(), batch]).combine_chunks()
            held = None
            if rows is None or not rows.num_rows:
                continue
            names = np.stack([rows.column(c).to_numpy().astype(np.int64) for c in ("slot", "bucket", "i", "j")])
            begins = np.flatnonzero(np.concatenate([[True], (names[:, 1:] != names[:, :-1]).any(axis=0)]))
            if batch is not None:  # the last group may go on
                held = rows.slice(begins[-1])
                if not begins[-1]:
                    continue
                rows, names, begins = rows.slice(0, begins[-1]), names[:, : begins[-1]], begins[:-1]
            found = _compared(rows, names, begins, k, tables, cosine)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in found], schema=schema)

    out = saved(groups.select("slot", "bucket", "i", "j", "vec_id", "own", "weight", "embedding").mapInArrow(compare, "vec_id long, links long, hub long"))
    found = components(out.select(F.col("vec_id").alias("a"), F.col("hub").alias("b")))
    counts = out.groupBy("vec_id").agg(F.sum("links").alias("links"))
    named = classes.drop("embedding").join(counts.withColumnRenamed("vec_id", "rep"), "rep", "left").join(found.withColumnRenamed("id", "rep"), "rep", "left")
    named = named.select("hi", "lo", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    own = single.drop("embedding").join(redealt(named, "hi", "lo"), ["hi", "lo"])
    joined = marked.drop("embedding").join(redealt(own, "vec_id"), ["vec_id", "hi", "lo"], "left")
    result = joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return result.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


#: Pairs whose vectors are multiplied at a time, and members of a group that is multiplied as a matrix.
PAIRS, DENSE = 40_000, 48


def _near(unit: np.ndarray, begins: np.ndarray, sizes: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of rows within groups of rows whose cosine is high enough."""
    left, right = [], []
    for n in np.unique(sizes[sizes > 1]).tolist():
        own = begins[sizes == n]
        a, b = np.triu_indices(n, 1)
        if n >= DENSE:
            for start in own.tolist():
                part = unit[start : start + n]
                near = (part @ part.T)[a, b] >= cosine
                left.append(start + a[near])
                right.append(start + b[near])
            continue
        step = max(1, PAIRS // len(a))
        for i in range(0, len(own), step):
            x, y = ((own[i : i + step, None] + z).ravel() for z in (a, b))
            near = np.einsum("ij,ij->i", unit[x], unit[y]) >= cosine
            left.append(x[near])
            right.append(y[near])
    none = [np.zeros(0, np.int64)]
    return np.concatenate(left or none), np.concatenate(right or none)


def _compared(rows: pa.Table, names: np.ndarray, begins: np.ndarray, k: int, tables: int, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links that members of two blocks of a bucket find, for many groups: weights counted here, and a hub in the same part for each."""
    ids, own, weight = (rows.column(c).to_numpy() for c in ("vec_id", "own", "weight"))
    group = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(ids))))
    out = []
    for at, many in _matrices(rows.column("embedding")):  # buckets of two lengths may share a key by chance
        unit, slot = normalised(many), names[0][at]
        _, starts, sizes = np.unique(group[at], return_index=True, return_counts=True)
        a, b = _near(unit, starts, sizes, cosine)
        across = (names[2][at][a] == names[3][at][a]) | (own[at][a] != own[at][b])
        a, b = a[across], b[across]
        linked_rows, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        if not len(a):
            continue
        keys, x, y = buckets(unit[linked_rows], k, tables), place[: len(a)], place[len(a) :]
        first = np.ones(len(a), bool)
        for i in range(0, len(a), PAIRS):
            part = slice(i, i + PAIRS)
            earlier = np.arange(tables) < slot[a[part]][:, None]
            first[part] = ~((keys[x[part]] == keys[y[part]]) & earlier).any(axis=1)
        w = weight[at][linked_rows]
        counts = np.bincount(x[first], w[y[first]], len(w)) + np.bincount(y[first], w[x[first]], len(w))
        hub = np.arange(len(w))
        while True:  # the least row that links reach, by minima along the links
            least = hub.copy()
            np.minimum.at(least, x, hub[y])
            np.minimum.at(least, y, hub[x])
            least = least[least]
            if (least == hub).all():
                break
            hub = least
        names_of = ids[at][linked_rows]
        out.append((names_of, counts.astype(np.int64), names_of[hub]))
    return tuple(np.concatenate([o[c] for o in out] or [np.zeros(0, np.int64)]) for c in range(3))
