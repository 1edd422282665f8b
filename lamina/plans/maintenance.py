"""Maintenance of tables of files: retention, compaction, sweeping, metrics."""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import date

from pyspark.sql import SparkSession

from ..operators.upsert import replace_table
from ..sources.storage import Entry, Storage


@dataclass(frozen=True)
class Metrics:
    files: int
    size_mb: float

    @property
    def average_mb(self) -> float:
        return self.size_mb / self.files if self.files else 0.0


def metrics(spark: SparkSession, path: str) -> Metrics:
    parts = Storage(spark).parts(path)
    return Metrics(len(parts), sum(p.size for p in parts) / 2**20)


def wants_compaction(m: Metrics, least_files: int = 32, target_mb: float = 64) -> bool:
    """Many small files; with a bound of 0 or less, more than one file."""
    return m.files > 1 if least_files <= 0 else m.files >= least_files and m.average_mb < target_mb


def compact(spark: SparkSession, path: str, partition: str | None = None, target_mb: float = 128) -> Metrics:
    """Rewrite a table into files of about a size."""
    found = metrics(spark, path)
    df = spark.read.parquet(path)
    n = max(1, round(found.size_mb / target_mb))
    replace_table(spark, df.repartition(n, partition) if partition else df.repartition(n), path, partition)
    return metrics(spark, path)


def drop_snapshots(spark: SparkSession, path: str, cutoff: date, partition: str = "snapshot_date") -> list[str]:
    """Delete the partitions of snapshots before a day; gives their days."""
    storage, gone, start = Storage(spark), [], f"{partition}="
    found = [e for e in storage.entries(path) if e.is_dir and e.name.startswith(start)]
    if not found:
        raise ValueError(f"{path} has no partitions by {partition}")
    for e in found:
        day = e.name.removeprefix(start)
        if day[:4].isdigit() and date.fromisoformat(day) < cutoff:
            storage.delete(e.path)
            gone.append(day)
    return gone


def sweep(spark: SparkSession, path: str, hours: float = 24, now: float | None = None) -> list[str]:
    """Delete what broken writes have left beside a table, once it is older than some hours."""
    storage, gone = Storage(spark), []
    folder, _, name = path.rstrip("/").rpartition("/")

    def stale(e: Entry) -> bool:
        return e.name.startswith((f"{name}.new-", f"{name}.old-")) and e.modified / 1000 < (now or time.time()) - hours * 3600

    for e in storage.entries(folder):
        if stale(e):
            storage.delete(e.path)
            gone.append(e.name)
    return gone


def maintain(spark: SparkSession, path: str, partition: str | None = None, least_files: int = 32, target_mb: float = 64, hours: float = 24, compaction: bool = True) -> Metrics:
    """Sweep, compact if that is worth it, sweep again."""
    sweep(spark, path, hours)
    found = metrics(spark, path)
    if compaction and wants_compaction(found, least_files, target_mb):
        found = compact(spark, path, partition)
        sweep(spark, path, hours)
    return found


def housekeeping_due(day: date, forced: bool = False) -> bool:
    """On Sundays, or when asked for."""
    return forced or day.weekday() == 6
