"""Publishing of silver and gold models to tables of files."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import upsert as u
from ..sources.contracts import Field, contract_type, differences, spark_type
from ..sources.storage import Storage
from .models import MODELS, Build, Model, fields

FULL, DAILY = "full_rebuild", "daily"
#: Columns of batches, which published tables do not have.
INTERNAL = ("_row_hash", "_ingest_run_id", "_ingest_ts", "_source_system", "_source_table", "_op", "_bronze_last_run_id", "_bronze_last_apply_ts", "_bronze_last_manifest_path")


class ContractBroken(ValueError):
    """A table does not have the columns that its contract names."""


def contract(m: Model) -> list[Field]:
    """The columns of a published model: its own, its run's, and the partition's date."""
    layer = m.lineage
    own = [Field(c, contract_type(spark_type("TIMESTAMP" if kind.startswith("timestamp") else _upper(kind)))) for c, kind in fields(m)]
    own += [Field(f"_{layer}_build_ts", "TIMESTAMP"), Field(f"_{layer}_model_name", "STRING"), Field(f"_{layer}_run_id", "STRING")]
    return own + ([Field(f"_{layer}_partition_date", "DATE")] if m.partition else [])


def _upper(kind: str) -> str:
    return {"smallint": "SHORT", "bigint": "LONG"}.get(kind, kind.upper())


def publishable(df: DataFrame, m: Model) -> DataFrame:
    """A model's table without columns of batches, and with the partition's date last."""
    out = df.drop(*INTERNAL)
    return out.withColumn(f"_{m.lineage}_partition_date", F.col(m.partition).cast("date")) if m.partition else out


def run_mode(spark: SparkSession, root: str, wanted: str, names: Iterable[str]) -> str:
    """The mode to publish in: a daily run becomes a full rebuild if a partitioned target is not there yet."""
    storage = Storage(spark)
    absent = [n for n in names if MODELS[n].partition and not storage.exists(target(root, MODELS[n]))]
    return FULL if wanted == DAILY and absent else wanted


def target(root: str, m: Model) -> str:
    return f"{root.rstrip('/')}/{m.lineage}/{m.alias or m.name}"


@dataclass
class Published:
    model: str
    path: str
    rows: int
    mode: str
    partitions: list[str]
    undated: int = 0


def publish(spark: SparkSession, build: Build, name: str, root: str, mode: str = FULL) -> Published:
    """Publish one model.

    A partitioned model replaces its table in a full rebuild. In a daily run its rows are merged by their keys into
    the days they touch, so that rows of those days which the run does not hold stay; without keys the days are
    replaced. Rows without a date are left out, and counted.
    """
    m, path = MODELS[name], target(root, MODELS[name])
    rows = publishable(build.published(name), m)
    if wrong := differences(rows, contract(m)):
        raise ContractBroken(f"{name}: {'; '.join(wrong)}")
    if not m.partition:
        u.replace_table(spark, rows, path)
        return Published(name, path, spark.read.parquet(path).count(), "replacement", [])
    part = f"_{m.lineage}_partition_date"
    rows = rows.persist()
    try:
        days = {r[0]: r[1] for r in rows.groupBy(part).count().collect()}
        undated = days.pop(None, 0)
        dated = rows.where(F.col(part).isNotNull())
        if days and mode == FULL:
            u.replace_table(spark, dated, path, part)
        elif days:
            if not Storage(spark).exists(path):
                raise ContractBroken(f"{name} is not published yet; a full rebuild comes first")
            if changed := {*spark.read.parquet(path).columns} ^ {*rows.columns}:
                raise ContractBroken(f"{name}: columns have changed: {', '.join(sorted(changed))}; a full rebuild is needed")
            if m.upsert_keys:
                u.upsert(spark, dated, path, [*m.upsert_keys], part, strict=False)
            else:
                u.replace_partitions(dated, path, part)
    finally:
        rows.unpersist()
    return Published(name, path, sum(days.values()), f"partitioned {mode}", sorted(d.isoformat() for d in days), undated)


def write_report(spark: SparkSession, root: str, run_id: str, done: list[Published]) -> str:
    """The run's list of published tables, as JSON beside them."""
    path = f"{root.rstrip('/')}/_published/{run_id}.json"
    Storage(spark).write_json(path, {"run_id": run_id, "tables": [vars(p) for p in done]})
    return path


def readable(spark: SparkSession, done: list[Published]) -> list[str]:
    """Published tables that can't be read with the columns of their contract."""
    wrong = []
    for p in done:
        if Storage(spark).exists(p.path):
            names = {f.name for f in contract(MODELS[p.model])}
            if names ^ {*spark.read.parquet(p.path).columns}:
                wrong.append(p.model)
        elif p.rows:
            wrong.append(p.model)
    return wrong
