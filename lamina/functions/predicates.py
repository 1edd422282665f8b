"""Predicates of incremental reads, as columns that reach the scan."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import col


def refresh_window(c: str | Column, logical_date: date | None, days: int) -> Column:
    """From days before the logical date on, later dates included; everything if there is no logical date."""
    if logical_date is None:
        return F.lit(True)
    return F.to_date(col(c)) >= F.date_sub(F.lit(logical_date), days)


def cursor_dates(changed: str, created: str | None, low: date, high: date, created_low: date | None = None) -> Column:
    """Rows changed between two dates, or never changed and created between two, all ends included."""
    own = F.col(changed).between(F.lit(low), F.lit(high))
    if not created:
        return own
    return (F.col(changed).isNotNull() & own) | (F.col(changed).isNull() & F.col(created).between(F.lit(created_low or low), F.lit(high)))


def cursor_times(changed: str, created: str | None, low: datetime, high: datetime, created_low: datetime | None = None) -> Column:
    """As cursor_dates for instants: behind the lower end, up to and including the upper one."""

    def within(c: str, start: datetime) -> Column:
        return (F.col(c) > F.lit(start)) & (F.col(c) <= F.lit(high))

    if not created:
        return within(changed, low)
    return (F.col(changed).isNotNull() & within(changed, low)) | (F.col(changed).isNull() & within(created, created_low or low))


def event_days(run_date: date, lookback: int) -> tuple[date, date]:
    """First day, and day behind the last one, of a lookback that ends on the run date; at least one day."""
    return run_date - timedelta(days=max(lookback, 1) - 1), run_date + timedelta(days=1)


def event_window(c: str, run_date: date, lookback: int) -> Column:
    start, end = event_days(run_date, lookback)
    return (F.col(c) >= F.lit(start)) & (F.col(c) < F.lit(end))


def touched(df: DataFrame, key: str, window: Column, sources: list[DataFrame], source_key: str) -> DataFrame:
    """Rows in the window, and rows whose key one of the sources names.

    The identifiers of all sources meet in one distinct set, so the rows are joined once.
    """
    ids = None
    for source in sources:
        own = source.select(F.col(source_key).alias("touched"))
        ids = own if ids is None else ids.unionByName(own)
    if ids is None:
        return df.where(window)
    marked = df.join(ids.where("touched is not null").distinct().withColumn("was touched", F.lit(True)), df[key] == F.col("touched"), "left")
    return marked.where(window | F.col("was touched")).drop("touched", "was touched")
