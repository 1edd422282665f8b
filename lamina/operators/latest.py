"""Selection of one row for each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import col


def latest_by(df: DataFrame, keys: list[str], order: list[str | Column], tie_break: list[str] | None = None) -> DataFrame:
    """The first row of each key by the order, each item descending with nulls last.

    tie_break: columns that make the order total; all others of the table if None are named, so that reruns agree.
    A window of row number 1 lets Spark keep one row for each key and task before it shuffles.
    """
    named = {o for o in order if isinstance(o, str)} | {*keys}
    rest = [c for c in df.columns if c not in named] if tie_break is None else tie_break
    by = [col(o).desc_nulls_last() for o in [*order, *(F.col(f"`{c}`") for c in rest)]]
    return df.withColumn("row of key", F.row_number().over(W.partitionBy(*keys).orderBy(*by))).where("`row of key` = 1").drop("row of key")


def apply_time(c: str = "_bronze_last_apply_ts") -> Column:
    """An apply time, which is text, as an instant; null if it is none."""
    return F.col(c).try_cast("timestamp")


def latest_snapshot(df: DataFrame, snapshot: str = "snapshot_date") -> DataFrame:
    """The rows of the greatest snapshot."""
    newest = df.agg(F.max(snapshot).alias("newest snapshot"))  # one row
    return df.join(F.broadcast(newest), df[snapshot] == F.col("newest snapshot")).drop("newest snapshot")


def top_per_key(df: DataFrame, right: DataFrame, key: str, right_key: str, order: list[str]) -> DataFrame:
    """Each row of df with the first row of right by the order, nulls where there is none: a lateral join of one row."""
    best = latest_by(right, [right_key], order)
    return df.join(best, df[key] == best[right_key], "left")
