"""Landing: immutable batches of source rows, each with a manifest and a marker, and the cursors of their tables."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta
from datetime import UTC as utc

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import with_ingest_columns
from ..functions.predicates import cursor_dates, cursor_times, event_days, event_window
from ..functions.scalars import instant, iso, safe_name
from ..operators.rollups import distinct_days
from ..operators.upsert import dealt
from . import manifest as m
from .groups import Table
from .storage import Storage


@dataclass(frozen=True)
class Run:
    """One extraction."""

    run_id: str
    run_date: date
    started: datetime
    base: str
    system: str = "postgres-pre-raw"
    schema: str = "source"
    contract_version: str = "1"

    def table_path(self, table: str) -> str:
        return f"{self.base}/{self.schema}/{table}"


def batch_path(run: Run, table: Table, value: str) -> str:
    mode = "snapshot" if table.group == "snapshots" else "incremental"
    return f"{run.table_path(table.name)}/mode={mode}/{table.partition_key}={value}/run_id={safe_name(run.run_id)}"


def state_path(run: Run, table: str) -> str:
    return f"{run.base}/{run.schema}/_state/_state_{table}.json"


def read_state(storage: Storage, run: Run, table: str) -> dict | None:
    return storage.read_json(state_path(run, table))


def write_batches(spark: SparkSession, df: DataFrame, run: Run, table: Table, values: Column, extra: dict | None = None) -> list[dict]:
    """Land rows as a batch for each value of the partition, and return their manifests.

    All batches are written by one job, from one reading of the source; counts and statistics come from the files.
    The marker that readers wait for comes last, behind a manifest that has been read back and holds. Rows whose
    value is null stay out.
    """
    storage, mode = Storage(spark), "snapshot" if table.group == "snapshots" else "incremental"
    key, root = table.partition_key, f"{run.table_path(table.name)}/mode={mode}"
    rows = with_ingest_columns(df, run.run_id, run.system, table.name, mode)
    named = rows.withColumns({key: values.cast("string"), "run_id": F.lit(safe_name(run.run_id))}).where(f"{key} is not null")
    writer = dealt(named, key).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    writer.partitionBy(key, "run_id").parquet(root)
    folders = {n.removeprefix(f"{key}="): f"{root}/{n}/run_id={safe_name(run.run_id)}" for n in storage.folders(root) if n.startswith(f"{key}=")}
    folders = {v: f for v, f in folders.items() if storage.parts(f)}
    if not folders:
        return []
    schema = T.StructType([*rows.schema, T.StructField(key, T.StringType()), T.StructField("run_id", T.StringType())])
    landed = spark.read.schema(schema).option("basePath", root).parquet(*folders.values())
    counts, profiles, hashed = m.file_rows(landed), m.profile(landed, df.columns, key), m.schema_hash(rows)
    return [_described(storage, run, table, value, folder, mode, counts, profiles.get(value, ({}, {})), hashed, extra) for value, folder in sorted(folders.items())]


def write_empty(spark: SparkSession, df: DataFrame, run: Run, table: Table, value: str, extra: dict | None = None) -> dict:
    """A batch without rows; it has a file all the same, as its manifest needs one."""
    storage, mode, folder = Storage(spark), "snapshot" if table.group == "snapshots" else "incremental", batch_path(run, table, value)
    rows = with_ingest_columns(df, run.run_id, run.system, table.name, mode).limit(0)
    rows.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(folder)
    return _described(storage, run, table, value, folder, mode, {}, ({c: 0 for c in df.columns}, {c: {"min": None, "max": None} for c in df.columns}), m.schema_hash(rows), extra)


def _described(storage: Storage, run: Run, table: Table, value: str, folder: str, mode: str, counts: dict, profile: tuple[dict, dict], hashed: str, extra: dict | None) -> dict:
    files = m.file_details(counts, storage, folder)
    rows = sum(f["row_count"] for f in files)
    said = {
        "manifest_version": "1.0", "source_system": run.system, "source_schema": run.schema, "source_table": table.name, "contract_name": f"{run.schema}.{table.name}",
        "contract_version": run.contract_version, "run_id": run.run_id, "ingest_ts_utc": iso(run.started), "batch_type": mode, "storage_format": "parquet",
        "schema_hash": hashed, "checksum": m.batch_checksum(files), "file_count": len(files), "row_count": rows, "files": files,
        "checks": [{"name": "row_count", "status": "pass", "details": str(rows)}], "min_max": profile[1], "null_counts": profile[0], "producer": "lamina",
        "source_extract": {"table": table.name, "partition_key": table.partition_key}, table.partition_key: value, **(extra or {}),
    }
    storage.write_json(f"{folder}/_manifest.json", said)
    if wrong := m.faults(storage.read_json(f"{folder}/_manifest.json") or {}):
        raise ValueError(f"the manifest of {folder} does not hold: {'; '.join(wrong)}")
    storage.write_text(f"{folder}/_SUCCESS", "")
    return said | {"path": folder}


def write_batch(spark: SparkSession, df: DataFrame, run: Run, table: Table, value: str, extra: dict | None = None) -> dict:
    """Land all rows as one batch, an empty one if there are none."""
    found = write_batches(spark, df, run, table, F.lit(value), extra)
    return found[0] if found else write_empty(spark, df, run, table, value, extra)


def extract_predicate(table: Table, run: Run, state: dict | None) -> tuple[Column | None, datetime, datetime]:
    """The filter of a changing table's rows since its cursor, and both ends; no filter without a cursor."""
    high = datetime.combine(run.run_date, time(), utc) if table.granularity == "date" else run.started
    if state is None and table.lookback <= 0:
        return None, datetime(1970, 1, 1, tzinfo=utc), high
    if table.lookback > 0:
        low = created = high - timedelta(days=table.lookback)
    else:
        low = instant(state["last_updated_at"]) if state.get("last_updated_at") else high - timedelta(days=1)
        created = instant(state["last_created_at"]) if state.get("last_created_at") else low
    if table.granularity == "date":
        if table.lookback > 0:
            low = created = high - timedelta(days=table.lookback - 1)
        return cursor_dates(table.changed, table.created, low.date(), high.date(), created.date()), low, high
    return cursor_times(table.changed, table.created, low, high, created), low, high


def land_snapshot(spark: SparkSession, source: DataFrame, run: Run, table: Table) -> dict | None:
    return write_batch(spark, source, run, table, run.run_date.isoformat())


def land_changes(spark: SparkSession, source: DataFrame, run: Run, table: Table) -> dict | None:
    """Rows changed since the cursor; the cursor moves only when they have landed."""
    storage = Storage(spark)
    predicate, low, high = extract_predicate(table, run, read_state(storage, run, table.name))
    rows = source if predicate is None else source.where(predicate)
    batch = write_batch(spark, rows, run, table, run.run_date.isoformat(), extra={"watermark": {"column": table.changed, "from": iso(low), "to": iso(high)}})
    storage.write_json(state_path(run, table.name), {
        "watermark_column": table.changed, "created_column": table.created, "cursor_granularity": table.granularity, "last_watermark": iso(high), "last_updated_at": iso(high),
        "last_created_at": iso(high), "last_successful_run_id": run.run_id, "last_successful_ingest_ts_utc": iso(run.started), "last_manifest_path": f"{batch['path']}/_manifest.json",
        "source_system": run.system, "source_schema": run.schema, "source_table": table.name,
    })
    return batch


def land_events(spark: SparkSession, source: DataFrame, run: Run, table: Table) -> tuple[list[dict], int]:
    """One batch for each day of the lookback, of every day on the first load; and the rows without a day, which stay out."""
    storage, c = Storage(spark), table.event_date
    lookback = max(table.lookback, 1)
    first = not storage.exists(f"{run.table_path(table.name)}/mode=incremental")
    rows = source if first else source.where(event_window(c, run.run_date, lookback))
    undated = source.where(F.col(c).isNull()).count()
    days = sorted(r[0] for r in distinct_days(rows, c).collect())
    start, end = (days[0], days[-1] + timedelta(days=1)) if first and days else event_days(run.run_date, lookback)
    extra = {"lookback_days": table.lookback, "window": {"from": start.isoformat(), "to": end.isoformat()}, "event_dates_covered": [d.isoformat() for d in days]}
    return write_batches(spark, rows, run, table, F.to_date(c), extra) if days else [], undated


def land(spark: SparkSession, source: DataFrame, run: Run, table: Table) -> list[dict]:
    """Land a table the way its group asks for."""
    if table.group == "snapshots":
        return [b for b in [land_snapshot(spark, source, run, table)] if b]
    if table.group == "mutable_dims":
        return [b for b in [land_changes(spark, source, run, table)] if b]
    return land_events(spark, source, run, table)[0]
