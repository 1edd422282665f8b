"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than space and the ASCII control white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Documents per Arrow batch; with long texts the byte bound below ends a batch earlier.
BATCH_ROWS = 500
BATCH_BYTES = 4 << 20
#: Bytes of a row group of an intermediate table.
ROW_GROUP = 8 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Set what the operators need of a session: a checkpoint folder, small Arrow batches, code on the workers.

    The checkpoint folder is the one the session names in spark.checkpoint.dir. Only a local session, whose tasks
    share this machine, may name none; on a cluster that is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("spark.checkpoint.dir names no folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = context.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        context.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)
    # allocators that give memory back: several workers share an executor's memory with its JVM
    for name, value in (("ARROW_DEFAULT_MEMORY_POOL", "system"), ("MALLOC_ARENA_MAX", "1"), ("MALLOC_TRIM_THRESHOLD_", "1048576")):
        context.environment.setdefault(name, value)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def saved(df: DataFrame) -> DataFrame:
    """The rows of df, written to the shared checkpoint folder, without lineage."""
    prepare(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the checkpoint folder, which goes when the driver ends."""
    context = prepare(spark).sparkContext
    path = f"{context.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(context._jsc.hadoopConfiguration())
    system.mkdirs(place)
    system.deleteOnExit(place)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written as Parquet to the shared folder: smaller than a checkpoint, and read by columns."""
    spark = df.sparkSession
    path = f"{shared_folder(spark, name)}/rows"
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)  # writers hold a row group in memory
    return spark.read.parquet(path)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def by_batch(df: DataFrame, rows: Callable[[pa.RecordBatch], Iterable[dict] | dict], schema: str, barrier: bool = False) -> DataFrame:
    """mapInArrow with a function from a batch to a dict of columns, or to an iterable of such dicts."""
    prepare(df.sparkSession)
    fields = [x.strip().split(None, 1) for x in _split(schema)]
    types = pa.schema([(name, _TYPES[kind]) for name, kind in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in task(batches):
            if batch.num_rows:
                out = rows(batch)
                for part in [out] if isinstance(out, dict) else out:
                    yield pa.RecordBatch.from_pydict(part, schema=types)

    return df.mapInArrow(run, ", ".join(f"`{n}` {k}" for n, k in fields), barrier)


_TYPES = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(),
    "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string()),
}


def _split(schema: str) -> list[str]:
    return [x for x in schema.split(",") if x.strip()]


_FORGETS: list[Callable[[], None]] = []


def trim() -> None:
    """Give memory that is free inside this process back to the machine, where the C library can."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def at_end(forget: Callable[[], None]) -> Callable[[], None]:
    """Register what makes an operator forget; workers run tasks of many operators, and remember nothing between tasks."""
    _FORGETS.append(forget)
    return forget


def task(items: Iterator) -> Iterator:
    """The items of a task; when it ends, whatever way, all that operators remember is dropped."""
    try:
        yield from items
    finally:
        for forget in _FORGETS:
            forget()
        trim()


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; a null counts as an empty text."""
    return [x or "" for x in batch.column(column).to_pylist()]


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the identifier's decimal text, modulo a number: the rule that assigns rows to folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
