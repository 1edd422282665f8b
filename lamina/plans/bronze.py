"""Bronze: landed batches applied to tables once each, and the registry that remembers them."""

from __future__ import annotations

import logging
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import instant, iso
from ..operators import upsert as u
from ..operators.latest import latest_by
from ..sources import manifest as m
from ..sources.contracts import Field, align
from ..sources.groups import Table
from ..sources.landing import Run, read_state
from ..sources.readers import with_file_facts
from ..sources.storage import Storage

log = logging.getLogger(__name__)

#: The registry's columns, text unless named a number; the first four may not be null.
REGISTRY = (
    "source_system", "source_schema", "source_table", "run_id", "manifest_path", "batch_type", "partition_kind", "partition_value", "ingest_ts_utc", "schema_hash",
    "contract_version", "apply_ts_utc", "status", "details", "watermark_from", "watermark_to", "lookback_days", "window_from", "window_to", "row_count", "file_count",
)
NUMBERS = {"lookback_days", "row_count", "file_count"}
REGISTRY_SCHEMA = T.StructType([T.StructField(c, T.IntegerType() if c in NUMBERS else T.StringType(), i > 3) for i, c in enumerate(REGISTRY)])
LINEAGE = ("_bronze_last_run_id", "_bronze_last_apply_ts", "_bronze_last_manifest_path")


@dataclass
class Registry:
    """An append-only log with a row for each attempt to apply a batch."""

    spark: SparkSession
    path: str

    def ensure(self) -> None:
        if not Storage(self.spark).exists(self.path):
            u.empty_table(self.spark, REGISTRY_SCHEMA, self.path, "source_table")

    def rows(self) -> DataFrame:
        if not Storage(self.spark).exists(self.path):
            return self.spark.createDataFrame([], REGISTRY_SCHEMA)
        return self.spark.read.schema(REGISTRY_SCHEMA).parquet(self.path).select(*REGISTRY)

    def of(self, run: Run, table: str) -> DataFrame:
        return self.rows().where((F.col("source_system") == run.system) & (F.col("source_schema") == run.schema) & (F.col("source_table") == table))

    def add(self, rows: list[dict]) -> None:
        if rows:
            df = self.spark.createDataFrame([tuple(r.get(c) for c in REGISTRY) for r in rows], REGISTRY_SCHEMA).coalesce(1)
            u.with_retries(lambda: u.append(df, self.path, "source_table"))


def latest_entry(rows: DataFrame, status: str | None = None) -> dict | None:
    """The last attempt, or the last one of a status."""
    own = rows if status is None else rows.where(F.col("status") == status)
    found = own.orderBy(F.col("apply_ts_utc").desc(), F.col("run_id").desc()).limit(1).collect()
    return found[0].asDict() if found else None


def search_start(table: Table, newest: date | None, state_day: date | None, run_date: date, known: bool) -> date | None:
    """The first partition to look at: None for all of them.

    newest: the greatest partition in the registry; state_day: the day of the last landing; known: whether the
    registry has rows of the table.
    """
    found = [newest] if newest else []
    if state_day and (known or table.partition_key != "extract_date"):
        found.append(state_day)
    if not found:
        if table.partition_key == "event_date" and (known or state_day):
            return run_date - timedelta(days=max(table.lookback, 1) - 1)
        return None
    return min(found) - timedelta(days={"snapshot_date": 0, "extract_date": 1, "event_date": table.lookback}[table.partition_key])


def _day(text: str) -> date | None:
    try:
        return date.fromisoformat(text)
    except ValueError:
        return None


def partitions(storage: Storage, run: Run, table: Table) -> list[date]:
    """The dates of a table's landed partitions, in order; folders of other names are passed over."""
    mode = "snapshot" if table.group == "snapshots" else "incremental"
    start = f"{table.partition_key}="
    found = (_day(n.removeprefix(start)) for n in storage.folders(f"{run.table_path(table.name)}/mode={mode}") if n.startswith(start))
    return sorted(d for d in found if d)


def candidates(storage: Storage, run: Run, table: Table, start: date | None) -> list[dict]:
    """Batches with a marker and a manifest, from a partition on."""
    mode, out = "snapshot" if table.group == "snapshots" else "incremental", []
    for day in partitions(storage, run, table):
        if start and day < start:
            continue
        folder = f"{run.table_path(table.name)}/mode={mode}/{table.partition_key}={day.isoformat()}"
        for name in storage.folders(folder):
            names = {e.name for e in storage.entries(f"{folder}/{name}")}
            if name.startswith("run_id=") and {"_SUCCESS", "_manifest.json"} <= names:
                out.append({"run_id": name.removeprefix("run_id="), "path": f"{folder}/{name}", "manifest_path": f"{folder}/{name}/_manifest.json", "partition_value": day.isoformat()})
    return out


def guard(said: dict | None, candidate: dict, table: Table, expected_hash: str | None = None, expected_version: str | None = None) -> tuple[str, str]:
    """("apply", "") for a batch that is to be applied, else ("skipped" or "failed", why); checked in this order."""
    if said is None:
        return "failed", "unreadable manifest"
    if wrong := m.faults(said):
        return "failed", "; ".join(wrong)
    if said["row_count"] == 0 and table.group != "snapshots":
        return "skipped", "empty batch"
    if expected_hash and said["schema_hash"] != expected_hash:
        return "failed", "schema hash differs"
    if expected_version and str(said["contract_version"]) != str(expected_version):
        return "skipped", "contract version differs"
    if m.partition_of(said) != (table.partition_key, candidate["partition_value"]):
        return "failed", "partition differs"
    if any(not f["path"] for f in said["files"]):
        return "failed", "a file has no path"
    return "apply", ""


def newest_batch(batches: list[dict]) -> tuple[dict | None, list[dict]]:
    """The snapshot to apply, the last landed of the last partition, and those that it supersedes."""
    ranked = sorted(batches, key=lambda b: (b["partition_value"], b["said"]["ingest_ts_utc"], b["run_id"]))
    return (ranked[-1], ranked[:-1]) if ranked else (None, [])


@dataclass
class Outcome:
    """What became of each table's batches; errors that were caught."""

    statuses: dict[str, Counter] = field(default_factory=dict)
    errors: dict[str, str] = field(default_factory=dict)


class Bronze:
    """Tables in a folder, to which batches are applied."""

    def __init__(self, spark: SparkSession, base: str, contracts: dict[str, list[Field]] | None = None, now=lambda: datetime.now(UTC)):
        self.spark, self.base, self.contracts, self.now = spark, base.rstrip("/"), contracts or {}, now
        self.storage, self.registry = Storage(spark), Registry(spark, f"{base.rstrip('/')}/ops/bronze_apply_registry")

    def path(self, table: str) -> str:
        return f"{self.base}/bronze/{table}"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def _entry(self, run: Run, table: Table, b: dict, status: str, details: str, at: str) -> dict:
        said = b.get("said") or {}
        watermark, window = said.get("watermark") or {}, said.get("window") or {}
        return {
            "source_system": run.system, "source_schema": run.schema, "source_table": table.name, "run_id": b["run_id"], "manifest_path": b["manifest_path"],
            "batch_type": said.get("batch_type"), "partition_kind": table.partition_key, "partition_value": b["partition_value"], "ingest_ts_utc": said.get("ingest_ts_utc"),
            "schema_hash": said.get("schema_hash"), "contract_version": said.get("contract_version"), "apply_ts_utc": at, "status": status, "details": details,
            "watermark_from": watermark.get("from"), "watermark_to": watermark.get("to"), "lookback_days": said.get("lookback_days"),
            "window_from": window.get("from"), "window_to": window.get("to"), "row_count": said.get("row_count"), "file_count": said.get("file_count"),
        }

    def pending(self, run: Run, table: Table, check_schema: bool = False) -> tuple[list[dict], list[dict], str]:
        """Batches to apply, in order; registry rows of those refused; the instant of this attempt."""
        own, at = self.registry.of(run, table.name), iso(self.now())
        done = {(r["run_id"], r["partition_value"]) for r in own.where(F.col("status").isin("applied", "skipped")).select("run_id", "partition_value").collect()}
        newest, known = own.agg(F.max("partition_value"), F.count("*")).first()
        state = read_state(self.storage, run, table.name)
        landed = instant(state["last_successful_ingest_ts_utc"]).date() if state and state.get("last_successful_ingest_ts_utc") else None
        start = search_start(table, date.fromisoformat(newest) if newest else None, landed, run.run_date, bool(known))
        last = latest_entry(own, "applied") or {}
        good, refused = [], []
        for b in candidates(self.storage, run, table, start):
            if (b["run_id"], b["partition_value"]) in done:
                continue
            try:
                b["said"] = self.storage.read_json(b["manifest_path"])
            except ValueError:
                b["said"] = None
            verdict, why = guard(b["said"], b, table, last.get("schema_hash") if check_schema else None, last.get("contract_version"))
            if verdict == "apply":
                good.append(b)
            else:
                refused.append(self._entry(run, table, b, verdict, why, at))
        return sorted(good, key=lambda b: (b["partition_value"], b["said"]["ingest_ts_utc"], b["run_id"])), refused, at

    def _rows(self, batches: list[dict], at: str) -> DataFrame:
        """The rows of all batches in one read, with the lineage of the batch that each comes from."""
        files = [f["path"] for b in batches for f in b["said"]["files"]]
        facts = [(f["path"], b["run_id"], at, b["manifest_path"], b["partition_value"]) for b in batches for f in b["said"]["files"]]
        table = self.spark.createDataFrame(facts, "path string, _bronze_last_run_id string, _bronze_last_apply_ts string, _bronze_last_manifest_path string, `landed partition` string")
        return with_file_facts(self.spark.read.parquet(*files), table)

    def _aligned(self, df: DataFrame, table: Table) -> DataFrame:
        contract = self.contracts.get(table.name)
        if not contract:
            return df
        out, extra = align(df, contract)
        if extra:
            log.warning("%s: columns outside the contract left out: %s", table.name, ", ".join(extra))
        return out

    def apply(self, run: Run, table: Table, check_schema: bool = False) -> Counter:
        """Apply a table's pending batches, each once, and record every attempt."""
        self.registry.ensure()
        good, entries, at = self.pending(run, table, check_schema)
        if table.group == "snapshots":
            newest, older = newest_batch(good)
            entries += [self._entry(run, table, b, "skipped", "superseded", at) for b in older]
            good = [newest] if newest else []
        if good:
            try:
                rows = self._rows(good, at)
                path = self.path(table.name)
                if table.group == "snapshots":
                    rows = rows.withColumn("snapshot_date", F.col("landed partition").cast("date")).drop("landed partition")
                    u.replace_partitions(self._aligned(rows, table), path, "snapshot_date")
                else:
                    # of several versions of a key in these batches the last landed counts
                    keys, part = [*table.keys], None
                    if table.partition_key == "event_date":
                        rows, part = rows.withColumn("event_date", F.col("landed partition").cast("date")), "event_date"
                    order = ["landed partition", "_ingest_ts", "_bronze_last_run_id", "_bronze_last_manifest_path"]
                    rows = latest_by(rows, [*keys, *([part] if part else [])], order, [c for c in rows.columns if not c.startswith("_") and c not in keys]).drop("landed partition")
                    rows = self._aligned(rows, table)
                    if table.apply == "append_only":
                        u.append(rows, path, part)
                    else:
                        u.upsert(self.spark, rows, path, keys, part, strict=False)
                entries += [self._entry(run, table, b, "applied", table.apply, at) for b in good]
            except Exception as e:
                entries += [self._entry(run, table, b, "failed", str(e)[:500], at) for b in good]
                self.registry.add(entries)
                raise
        self.registry.add(entries)
        return Counter(e["status"] for e in entries)

    def apply_all(self, run: Run, tables: Iterable[Table], strict: bool = False) -> Outcome:
        """Apply several tables; one that fails is recorded and does not stop the others, unless strict."""
        out = Outcome()
        for t in tables:
            try:
                out.statuses[t.name] = self.apply(run, t)
            except Exception as e:
                if strict:
                    raise
                log.exception("%s failed", t.name)
                out.statuses[t.name], out.errors[t.name] = Counter(failed=1), str(e)
        return out
