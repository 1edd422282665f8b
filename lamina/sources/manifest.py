"""Batch manifests: what a landed batch says of itself, and whether it holds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import md5
from ..operators.rollups import column_profile
from .storage import Storage

#: Fixed values of the protocol.
REQUIRED = (
    "manifest_version", "source_system", "source_schema", "source_table", "contract_name", "contract_version", "run_id", "ingest_ts_utc", "batch_type", "storage_format",
    "schema_hash", "checksum", "file_count", "row_count", "files", "checks", "min_max", "null_counts", "producer", "source_extract",
)
FILE_KEYS = ("path", "size_bytes", "row_count", "checksum")
PARTITIONS = ("snapshot_date", "extract_date", "event_date")


def schema_hash(df: DataFrame) -> str:
    return md5(df.schema.json())


def file_rows(df: DataFrame) -> dict[str, int]:
    """Rows of each file that df reads, in one job."""
    return {_plain(r[0]): r[1] for r in df.groupBy(F.url_decode(F.col("_metadata.file_path"))).count().collect()}


def file_details(counts: dict[str, int], storage: Storage, folder: str) -> list[dict]:
    """The data files of a folder."""
    parts = storage.parts(folder)
    return [{"path": e.path, "size_bytes": e.size, "row_count": counts.get(_plain(e.path), 0), "checksum": f"len:{e.size}-mtime:{e.modified}"} for e in parts]


def _plain(path: str) -> str:
    return "file:/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


def batch_checksum(files: list[dict]) -> str:
    return md5("|".join(f"{f.get('path', '')}:{f.get('checksum', '')}" for f in sorted(files, key=lambda f: f.get("path", ""))))


def profile(df: DataFrame, columns: list[str], by: str) -> dict[object, tuple[dict[str, int], dict[str, dict]]]:
    """Null counts, and least and greatest values as text, of each column, for each batch; all in one job."""
    out: dict[object, tuple[dict, dict]] = {}
    for r in column_profile(df, columns, [by]).collect():
        nulls, ranges = out.setdefault(r[by], ({}, {}))
        nulls[r["column_name"]], ranges[r["column_name"]] = r["null_count"], {"min": r["min_value"], "max": r["max_value"]}
    return out


def partition_of(manifest: dict) -> tuple[str, str]:
    """The kind and value of a batch's partition; empty if it has none."""
    return next(((k, manifest[k]) for k in PARTITIONS if k in manifest), ("", ""))


def _named(kind: str) -> Callable[[dict], bool]:
    return lambda said: partition_of(said)[0] == kind


def _looks_back(said: dict) -> bool:
    return _named("event_date")(said) and bool(said.get("lookback_days"))


def _filled(value: object, *keys: str) -> bool:
    return isinstance(value, dict) and all(value.get(k) for k in keys)


def _list(said: dict, key: str) -> list:
    return said[key] if isinstance(said.get(key), list) else []


#: (what is said of a manifest that breaks the rule, which manifests it concerns, what must hold of them)
RULES: tuple[tuple[str, Callable[[dict], bool], Callable[[dict], bool]], ...] = (
    *((f"{key} has no value", lambda said: True, lambda said, key=key: said.get(key) is not None) for key in REQUIRED),
    ("the batch is neither a snapshot nor incremental", lambda said: said.get("batch_type") is not None, lambda said: said["batch_type"] in ("snapshot", "incremental")),
    ("it names no files", lambda said: said.get("files") is not None, lambda said: bool(_list(said, "files"))),
    *((f"a file is without its {key}", lambda said: True, lambda said, key=key: all(isinstance(f, dict) and key in f for f in _list(said, "files"))) for key in FILE_KEYS),
    ("the number of files is not the one stated", lambda said: isinstance(said.get("file_count"), int) and bool(_list(said, "files")), lambda said: said["file_count"] == len(said["files"])),
    ("checks are no list", lambda said: said.get("checks") is not None, lambda said: isinstance(said["checks"], list)),
    ("a check of the producer failed", lambda said: True, lambda said: all(c.get("status") != "fail" for c in _list(said, "checks"))),
    ("it belongs to no partition", lambda said: True, lambda said: bool(partition_of(said)[0])),
    ("the watermark of an extract lacks its column or an end", _named("extract_date"), lambda said: _filled(said.get("watermark"), "column", "from", "to")),
    ("a lookback lacks an end of its window", _looks_back, lambda said: _filled(said.get("window"), "from", "to")),
    ("a lookback does not list the days it covers", _looks_back, lambda said: bool(said.get("event_dates_covered"))),
)


def faults(manifest: dict) -> list[str]:
    """Everything that is wrong with a manifest; empty if it holds."""
    return [text for text, concerns, holds in RULES if concerns(manifest) and not holds(manifest)]
