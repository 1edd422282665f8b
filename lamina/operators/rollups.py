"""Aggregations: order values, column profiles, checksums, integer allocation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.columns import money


def value_rollup(lines: DataFrame, key: str, quantity: str, price: str, latest: list[str] | None = None) -> DataFrame:
    """Quantity, value and number of lines for each key, with the greatest of further columns; one shuffle of partial sums."""
    return lines.groupBy(key).agg(
        F.sum(quantity).cast("decimal(38,2)").alias("ordered_quantity"),
        money(F.sum(F.col(quantity) * F.col(price)), 38, 4).alias("line_sales_amount"),
        F.count("*").alias("line_count"),
        *(F.max(c).alias(c) for c in latest or []),
    )


def column_profile(df: DataFrame, columns: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """(column_name, null_count, min_value, max_value) as text, for each column, from one pass; by: and for each group."""
    names = columns or df.columns
    exprs: list[Column] = []
    for i, c in enumerate(names):
        own = F.col(f"`{c}`")
        exprs.append(F.struct(F.lit(c).alias("column_name"), F.count_if(own.isNull()).alias("null_count"), F.min(own).cast("string").alias("min_value"), F.max(own).cast("string").alias("max_value")).alias(f"p{i}"))
    grouped = df.groupBy(*by).agg(*exprs) if by else df.agg(*exprs)
    return grouped.select(*(by or []), F.inline(F.array(*(f"p{i}" for i in range(len(names))))))


def batch_checksum(files: DataFrame, path: str = "path", checksum: str = "checksum") -> DataFrame:
    """(checksum): the digest of a batch's files in order of their paths; a batch is a few files."""
    return files.agg(F.md5(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", path, checksum))), "|")).alias("checksum"))


def distinct_days(df: DataFrame, c: str) -> DataFrame:
    """(event_date): the distinct dates of a column, without null."""
    return df.select(F.to_date(c).alias("event_date")).where("event_date is not null").distinct()


def headers(lines: DataFrame, key: str, first: dict[str, str], total: dict[str, str], order: list[str]) -> DataFrame:
    """One header for each key: the first of some columns by an order, the sum of others."""
    by = F.struct(*order)
    return lines.groupBy(key).agg(*(F.min_by(c, by).alias(n) for n, c in first.items()), *(F.sum(c).alias(n) for n, c in total.items()))


def allocate(df: DataFrame, group: list[str], total: str, weight: str, order: str, out: str) -> DataFrame:
    """A whole total of each group dealt to its rows by weight, none of it lost.

    Every row gets the whole part of its share; what is left goes, one each, to the rows of largest fraction, the
    earlier in the order first.
    """
    raw = F.col(total) * F.col(weight)
    shares = df.withColumn("raw share", raw.cast("double")).withColumn("whole share", F.floor("raw share").cast("long"))
    left = F.col(total) - F.sum("whole share").over(W.partitionBy(*group))
    rank = F.row_number().over(W.partitionBy(*group).orderBy((F.col("raw share") - F.col("whole share")).desc(), F.col(order).asc()))
    return shares.withColumn(out, (F.col("whole share") + F.when(rank <= left, 1).otherwise(0)).cast("long")).drop("raw share", "whole share")
