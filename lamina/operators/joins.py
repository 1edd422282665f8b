"""Joins that the models share.

Left sides are facts; Spark broadcasts a right side when it knows it to be small, and shuffles it otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def lookup(df: DataFrame, other: DataFrame, keys: dict[str, str], take: dict[str, str] | list[str]) -> DataFrame:
    """df with columns of other under names given, by equality of df's keys with other's; nulls where none matches."""
    names = take if isinstance(take, dict) else {c: c for c in take}
    right = other.select(*(F.col(k).alias(f"key {k}") for k in keys.values()), *(F.col(c).alias(n) for c, n in names.items()))
    on = [df[a] == right[f"key {b}"] for a, b in keys.items()]
    return df.join(right, on, "left").drop(*(f"key {k}" for k in keys.values()))


def validity_join(df: DataFrame, versions: DataFrame, keys: list[str], at: str, take: list[str], start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """df with columns of the versions that are valid at a date: from start on, before end, an open end being null.

    Overlapping versions give a row each; without a valid version the columns are null.
    """
    right = versions.select(*(F.col(k).alias(f"key {k}") for k in keys), F.col(start).alias("version start"), F.col(end).alias("version end"), *take)
    on = [df[k] == right[f"key {k}"] for k in keys]
    on += [df[at] >= F.col("version start"), F.col("version end").isNull() | (df[at] < F.col("version end"))]
    return df.join(right, on, "left").drop("version start", "version end", *(f"key {k}" for k in keys))


def overlapping_versions(versions: DataFrame, keys: list[str], start: str = "valid_from", end: str = "valid_to") -> DataFrame:
    """Versions that begin before an earlier version of their key ends."""
    by = W.partitionBy(*keys).orderBy(F.col(start).asc_nulls_first(), F.col(end).asc_nulls_last())
    never = F.lit("9999-12-31").cast("date")
    before = F.max(F.coalesce(F.col(end), never)).over(by.rowsBetween(W.unboundedPreceding, -1))
    return versions.withColumn("end before", before).where(F.col(start) < F.col("end before")).drop("end before")


def missing_keys(df: DataFrame, other: DataFrame, keys: list[str], forms: dict[str, Column] | None = None) -> DataFrame:
    """Rows of df whose keys other does not have; forms: how keys are made comparable. Null keys equal null keys."""
    form = lambda d, k: (forms or {}).get(k, F.col(k))
    left = df.withColumns({f"key {k}": form(df, k) for k in keys})
    right = other.select(*(form(other, k).alias(f"other {k}") for k in keys)).distinct()
    on: Column | None = None
    for k in keys:
        same = F.col(f"key {k}").eqNullSafe(F.col(f"other {k}"))
        on = same if on is None else on & same
    return left.join(right, on, "left_anti").drop(*(f"key {k}" for k in keys))


def not_in(df: DataFrame, column: str, other: DataFrame, other_column: str) -> DataFrame:
    """SQL's NOT IN: nothing if other holds a null, and no rows with a null unless other is empty."""
    names = other.select(F.col(other_column).alias("excluded"))
    left = df.join(names.where("excluded is not null").distinct(), F.col(column) == F.col("excluded"), "left_anti")
    # one row with the two facts about other that decide about nulls
    facts = F.broadcast(names.agg(F.count("*").alias("others"), F.count_if(F.col("excluded").isNull()).alias("null others")))
    decided = left.join(facts, (F.col("others") == 0) | ((F.col("null others") == 0) & F.col(column).isNotNull()))
    return decided.drop("others", "null others")
