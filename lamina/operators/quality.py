"""Data-quality rules: each gives the rows that break it."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_rows(df: DataFrame, c: str) -> DataFrame:
    return df.where(F.col(c).isNull())


def repeated_values(df: DataFrame, c: str) -> DataFrame:
    """(value, n): values other than null that occur more than once."""
    return df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("value")).agg(F.count("*").alias("n")).where("n > 1")


def not_positive(df: DataFrame, c: str) -> DataFrame:
    """Rows with 0 or less; null passes."""
    return df.where(F.col(c) <= 0)


def orphans(df: DataFrame, c: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose value, other than null, the parent does not have."""
    return df.where(F.col(c).isNotNull()).join(parent.select(F.col(parent_column).alias("parent value")).distinct(), F.col(c) == F.col("parent value"), "left_anti")


@dataclass(frozen=True)
class Rule:
    model: str
    column: str
    kind: str
    parent: str | None = None
    parent_column: str | None = None

    def broken(self, table) -> DataFrame:
        """Rows that break the rule, given a function from a model's name to its table."""
        df = table(self.model)
        if self.kind == "relationships":
            return orphans(df, self.column, table(self.parent), self.parent_column)
        return {"not_null": null_rows, "unique": repeated_values, "positive": not_positive}[self.kind](df, self.column)


def broken_counts(rules: list[Rule], table) -> dict[Rule, int]:
    """How many rows break each rule; the rules about single values of a model are counted in one pass over it."""
    out: dict[Rule, int] = {}
    simple = [r for r in rules if r.kind in ("not_null", "positive")]
    for model in dict.fromkeys(r.model for r in simple):
        own = [r for r in simple if r.model == model]
        tests = [F.count_if(F.col(r.column).isNull() if r.kind == "not_null" else F.col(r.column) <= 0) for r in own]
        out.update(zip(own, table(model).agg(*(t.alias(f"n{i}") for i, t in enumerate(tests))).first(), strict=True))
    return out | {r: r.broken(table).count() for r in rules if r not in out}


def report(rules: list[Rule], table) -> DataFrame:
    """(model, column_name, rule, broken) for every rule; one count each, in one job."""
    parts = [r.broken(table).agg(F.count("*").alias("broken")).select(F.lit(r.model).alias("model"), F.lit(r.column).alias("column_name"), F.lit(r.kind).alias("rule"), "broken") for r in rules]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def stale(df: DataFrame, applied: str, now: datetime, after: timedelta = timedelta(hours=6)) -> bool:
    """Whether the newest row was applied too long ago, or there is none."""
    newest = df.agg(F.max(F.col(applied).try_cast("timestamp")).alias("newest")).select(F.unix_seconds("newest")).first()[0]
    return newest is None or now.timestamp() - newest > after.total_seconds()
