"""Expressions over columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*parts: str | Column) -> Column:
    """Parts as text between bars; a null part is left out, so keys with nulls may collide."""
    return F.concat_ws("|", *(col(p).cast("string") for p in parts))


def row_hash(columns: list[str]) -> Column:
    """SHA-256 over columns as text in the order given, with a mark for nulls."""
    return F.sha2(F.concat_ws("||", *(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("<NULL>")) for c in columns)), 256)


def money(c: str | Column, precision: int = 18, scale: int = 4) -> Column:
    return col(c).cast(f"decimal({precision},{scale})")


def or_zero(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit(0))


def amounts_match(total: str | Column, lines: str | Column, tolerance: str = "0.01") -> Column:
    """Whether two amounts differ by less than the tolerance; a null total gives null, null lines count as 0."""
    return F.abs(col(total) - or_zero(lines)) < F.lit(tolerance).cast("decimal(10,4)")


def share(part: str | Column, whole: str | Column) -> Column:
    """part / whole as decimal(10,4); null where the whole is 0.

    Both are narrow decimals when they are divided: of wide ones Spark keeps six digits, and rounding those again
    would be wrong.
    """
    return F.when(col(whole) == 0, None).otherwise(money(part) / money(whole)).cast("decimal(10,4)")


def with_ingest_columns(df: DataFrame, run_id: str, system: str, table: str, op: str) -> DataFrame:
    """The technical columns of a landed batch behind the source's own."""
    return df.withColumns({
        "_row_hash": row_hash(df.columns), "_ingest_run_id": F.lit(run_id), "_ingest_ts": F.current_timestamp(),
        "_source_system": F.lit(system), "_source_table": F.lit(table), "_op": F.lit(op),
    })


def with_lineage(df: DataFrame, layer: str, model: str, run_id: str, built: str) -> DataFrame:
    """Run constants of a silver or gold model."""
    return df.select("*", F.lit(built).cast("timestamp").alias(f"_{layer}_build_ts"), F.lit(model).alias(f"_{layer}_model_name"), F.lit(run_id).alias(f"_{layer}_run_id"))


def comparable(c: str | Column, kind: str) -> Column:
    """A key in the form in which keys of two engines are compared: instants in microseconds, the rest as text."""
    return F.unix_micros(col(c).cast("timestamp")).cast("string") if kind.startswith("timestamp") else col(c).cast("string")
