"""Writes that change tables: upsert, partition replacement, append, for tables of Parquet files."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.storage import Storage
from .joins import missing_keys


class RepeatedKeys(ValueError):
    """A source of an upsert has a key twice."""


def require_unique(df: DataFrame, keys: list[str]) -> None:
    repeated = df.groupBy(*keys).count().where("count > 1").limit(3).collect()
    if repeated:
        raise RepeatedKeys(f"repeated keys, such as {[tuple(r)[:-1] for r in repeated]}")


def merged(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The target with rows of the source in place of those with equal keys, and the source's other rows added.

    Keys that hold nulls match nothing, as in SQL's MERGE. A column that one side lacks is null there.
    """
    known = source.dropna(subset=keys)
    return missing_keys(target, known, keys).unionByName(source, allowMissingColumns=True)


def dealt(df: DataFrame, *partitions: str | None) -> DataFrame:
    """Rows dealt out by the partitions that they are written to: few files for each, and large ones split."""
    named = [p for p in partitions if p]
    return df.hint("rebalance", *named) if named else df


def append(df: DataFrame, path: str, partition: str | None = None) -> None:
    dealt(df, partition).write.mode("append").partitionBy(*([partition] if partition else [])).parquet(path)


def replace_partitions(df: DataFrame, path: str, partition: str) -> None:
    """Replace the partitions that df has rows of, and no others, in one commit; rows without a partition stay out."""
    rows = df.where(F.col(partition).isNotNull())
    dealt(rows, partition).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def replace_table(spark: SparkSession, df: DataFrame, path: str, partition: str | None = None) -> None:
    """Replace a whole table, which df may read: new files stand beside the old ones until they are complete."""
    storage, fresh = Storage(spark), f"{path.rstrip('/')}.new-{uuid.uuid4().hex}"
    dealt(df, partition).write.mode("overwrite").partitionBy(*([partition] if partition else [])).parquet(fresh)
    old = f"{path.rstrip('/')}.old-{uuid.uuid4().hex}"
    if storage.exists(path):
        storage.rename(path, old)
    storage.rename(fresh, path)
    storage.delete(old)


def upsert(spark: SparkSession, source: DataFrame, path: str, keys: list[str], partition: str | None = None, strict: bool = True) -> None:
    """Merge a source into a table by its keys and, if it has partitions, within those that the source touches.

    As the match includes the partition, a row whose partition changes leaves its old version behind in the old
    one. strict: raise if the source repeats a key.
    """
    on = [*keys, *([partition] if partition and partition not in keys else [])]
    if strict:
        require_unique(source, on)
    if not Storage(spark).exists(path):
        append(source, path, partition)
        return
    target = spark.read.parquet(path)
    if partition is None:
        replace_table(spark, merged(target, source, on), path)
        return
    # a few days, named to the scan so that it reads no other partitions
    days = [r[0] for r in source.select(partition).distinct().collect()]
    kept = target.where(F.col(partition).isin([d for d in days if d is not None]))
    replace_partitions(merged(kept, source, on), path, partition)


def with_retries(write: Callable[[], None], attempts: int = 5, on: tuple[type[Exception], ...] = (Exception,), wait: Callable[[float], None] = time.sleep) -> int:
    """Run a write again when it collides with another; gives the attempts it took."""
    for n in range(attempts):
        try:
            write()
            return n + 1
        except on:
            if n + 1 == attempts:
                raise
            wait(1 + n)
    raise ValueError("no attempts")


def numbered_rows(df: DataFrame, existing: DataFrame, column: str, order: list[str], slots: int = 256) -> DataFrame:
    """New rows with consecutive identifiers behind the greatest existing one.

    Rows are numbered within slots, by a hash of the columns that identify them, and slots one behind the other, so
    that no task has to see all rows; the same rows get the same numbers.
    """
    top = existing.agg(F.coalesce(F.max(column), F.lit(0)).alias("top id"))  # one row
    rows = df.withColumn("slot of row", F.pmod(F.xxhash64(*order), F.lit(slots)))
    sizes = rows.groupBy("slot of row").agg(F.count("*").alias("rows of slot"))
    before = F.coalesce(F.sum("rows of slot").over(W.orderBy("slot of row").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(F.col("slot of row").alias("slot"), before.alias("rows before")).crossJoin(top)  # a row for each slot
    placed = rows.join(F.broadcast(starts), F.col("slot of row") == F.col("slot"))
    own = F.row_number().over(W.partitionBy("slot of row").orderBy(*order))
    return placed.withColumn(column, (F.col("top id") + F.col("rows before") + own).cast("int")).drop("slot of row", "slot", "rows before", "top id")


def insert_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    return target.unionByName(rows)


def update_rows(target: DataFrame, condition, values: dict) -> DataFrame:
    """The target with columns set where a condition holds."""
    return target.withColumns({c: F.when(condition, v).otherwise(F.col(c)).cast(target.schema[c].dataType) for c, v in values.items()})


def delete_rows(target: DataFrame, condition) -> DataFrame:
    """The target without the rows for which a condition is true; rows for which it is null stay."""
    return target.where(~F.coalesce(condition, F.lit(False)))


def replace_keys(target: DataFrame, rows: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """The target with all rows of some values of a column replaced by others."""
    return delete_rows(target, F.col(column).isin([*values])).unionByName(rows)


def empty_table(spark: SparkSession, schema: T.StructType, path: str, partition: str) -> None:
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(partition).parquet(path)
