"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from .joins import missing_keys


def union_filled(*frames: DataFrame) -> DataFrame:
    """All rows, repeated ones included; columns are matched by name, and missing ones are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def concat_rows(*frames: DataFrame) -> DataFrame:
    """All rows of tables with the same columns."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def unique_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.dropDuplicates(columns) if columns else df.distinct()


def key_difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """The keys of a that b does not have."""
    return missing_keys(a.select(*keys).distinct(), b, keys)
