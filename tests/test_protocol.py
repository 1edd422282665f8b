import json
from datetime import UTC, date, datetime

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lamina.plans.bronze import Bronze, guard, newest_batch, search_start
from lamina.sources import manifest as m
from lamina.sources import readers
from lamina.sources.groups import TABLES, Table, from_documents, with_lookbacks
from lamina.sources.landing import Run, land, land_events, read_state
from lamina.sources.storage import Storage
from lamina.streaming.apply import apply_stream, event_stream

EVENTS = Table("events", "events", ("id",), event_date="at", lookback=2)


def run(base, name, day, version="1"):
    return Run(name, day, datetime(day.year, day.month, day.day, 4, tzinfo=UTC), f"{base}/raw", contract_version=version)


def events(spark, *rows):
    return spark.createDataFrame([(i, datetime(2024, 1, d, 5), v) for i, d, v in rows], "id int, at timestamp_ntz, v string")


def good(**changes):
    out = dict.fromkeys(m.REQUIRED, "x") | {"batch_type": "snapshot", "files": [dict.fromkeys(m.FILE_KEYS, 1)], "file_count": 1, "row_count": 1, "checks": [], "snapshot_date": "2024-01-01"}
    return {k: v for k, v in (out | changes).items() if v != "gone"}


@pytest.mark.parametrize("key", m.REQUIRED)
def test_manifest_needs_every_key(key):
    assert m.faults(good()) == []
    assert f"{key} has no value" in m.faults(good(**{key: "gone"})) and f"{key} has no value" in m.faults(good(**{key: None}))


def test_manifest_faults():
    extract = {"snapshot_date": "gone", "batch_type": "incremental", "extract_date": "2024-01-01"}
    event = {"snapshot_date": "gone", "batch_type": "incremental", "event_date": "2024-01-01", "lookback_days": 2}
    window, half = {"from": "a", "to": "b"}, {"from": "a"}
    cases = [
        (good(batch_type="other"), "neither"), (good(files=[]), "no files"), (good(files=[{"path": 1, "size_bytes": 1, "row_count": 1}]), "its checksum"), (good(files="x"), "no files"),
        (good(file_count=2), "number of files"), (good(checks={}), "no list"), (good(checks=[{"status": "fail"}]), "producer"), (good(snapshot_date="gone"), "no partition"),
        (good(**extract), "watermark"), (good(**extract, watermark={"column": "c", "from": "f"}), "watermark"), (good(**event, window=half, event_dates_covered=["d"]), "end of its window"),
        (good(**event, window=window), "days it covers"),
    ]
    for document, said in cases:
        found = m.faults(document)
        assert len(found) == 1 and said in found[0], (said, found)
    assert len(m.faults(good(**event))) == 2 and len(m.faults({})) == len(m.REQUIRED) + 1
    assert m.faults(good(**extract, watermark={"column": "c", "from": "f", "to": "t"})) == []
    assert m.faults(good(**event, window=window, event_dates_covered=["d"])) == []


def test_guard_order():
    b = {"partition_value": "2024-01-01"}
    t = Table("s", "snapshots")
    assert guard(None, b, t)[0] == "failed"
    assert guard(good(row_count=0), b, t) == ("apply", "")
    assert guard(good(schema_hash="a"), b, t, expected_hash="b") == ("failed", "schema hash differs")
    assert guard(good(contract_version="2"), b, t, expected_version="1") == ("skipped", "contract version differs")
    assert guard(good(), {"partition_value": "2024-01-02"}, t) == ("failed", "partition differs")
    empty = good(snapshot_date="gone", batch_type="incremental", event_date="2024-01-01", row_count=0)
    assert guard(empty, b, EVENTS) == ("skipped", "empty batch")


DAY = date(2024, 1, 10)


@pytest.mark.parametrize(
    ("group", "newest", "state", "known", "expected"),
    [
        ("snapshots", None, None, False, None), ("snapshots", date(2024, 1, 5), None, True, date(2024, 1, 5)),
        ("mutable_dims", None, date(2024, 1, 9), False, None), ("mutable_dims", date(2024, 1, 5), date(2024, 1, 4), True, date(2024, 1, 3)),
        ("events", None, None, False, None), ("events", None, None, True, date(2024, 1, 9)), ("events", date(2024, 1, 9), None, True, date(2024, 1, 7)),
    ],
)
def test_search_start(group, newest, state, known, expected):
    assert search_start(Table("t", group, lookback=2), newest, state, DAY, known) == expected


@given(st.sampled_from(["snapshots", "mutable_dims", "facts", "events"]), st.none() | st.dates(), st.none() | st.dates(), st.integers(0, 9), st.booleans())
def test_search_never_starts_behind_what_is_known(group, newest, state, lookback, known):
    start = search_start(Table("t", group, lookback=lookback), newest if newest and newest.year > 1 else None, state if state and state.year > 1 else None, DAY, known)
    assert start is None or not newest or newest.year == 1 or start <= newest


def test_newest_batch():
    b = lambda p, t, r: {"partition_value": p, "run_id": r, "said": {"ingest_ts_utc": t}}
    best, older = newest_batch([b("1", "9", "z"), b("2", "1", "a"), b("2", "1", "b")])
    assert best["run_id"] == "b" and len(older) == 2
    assert newest_batch([]) == (None, [])


def test_groups():
    assert [TABLES[n].apply for n in ("stores", "clients", "orders", "payments", "delivery_tracking")] == ["snapshot_history", "merge", "append_only", "merge", "merge"]
    wide = with_lookbacks(TABLES, {"facts": 3, "events": -1})
    assert wide["orders"].apply == "merge" and wide["payments"].lookback == 3 and wide["delivery_tracking"].lookback == 0
    own = from_documents([{"group": "events", "lookback_days": 2}, {"group": "snapshots"}], {"events": {"e": {"event_date_column": "at", "merge_keys": ["id"]}}, "snapshots": ["s"]})
    assert own["e"].lookback == 2 and own["e"].keys == ("id",) and own["s"].group == "snapshots"
    with pytest.raises(ValueError):
        from_documents([], {"x": []})


def test_events_land_by_day_and_apply_once(spark, tmp_path):
    base, tool = str(tmp_path), Bronze(spark, str(tmp_path))
    first, source = run(base, "r 1", date(2024, 1, 3)), events(spark, (1, 1, "a"), (2, 2, "b"), (3, 3, "c")).unionByName(spark.sql("SELECT 9 AS id, CAST(NULL AS TIMESTAMP_NTZ) AS at, 'n' AS v"))
    batches, undated = land_events(spark, source, first, EVENTS)
    assert [b["event_date"] for b in batches] == ["2024-01-01", "2024-01-02", "2024-01-03"] and undated == 1
    assert all(b["row_count"] == 1 and b["null_counts"] == {"id": 0, "at": 0, "v": 0} for b in batches)
    assert tool.apply(first, EVENTS) == {"applied": 3}
    assert tool.apply(first, EVENTS) == {}
    second = run(base, "r2", date(2024, 1, 3))
    batches, _ = land_events(spark, events(spark, (1, 1, "late"), (2, 2, "B"), (4, 3, "d")), second, EVENTS)
    assert [b["event_date"] for b in batches] == ["2024-01-02", "2024-01-03"]
    tool.apply(second, EVENTS)
    assert sorted((r.id, r.v) for r in tool.table("events").collect()) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    log = tool.registry.rows()
    assert log.count() == 5 and {r.status for r in log.collect()} == {"applied"} and log.columns[-1] == "file_count"
    assert {r._bronze_last_run_id for r in tool.table("events").collect()} == {"r_1", "r2"}


def test_append_only_facts_repeat_across_runs(spark, tmp_path):
    base, tool, t = str(tmp_path), Bronze(spark, str(tmp_path)), Table("facts", "facts", ("id",), event_date="at")
    for name in ("r1", "r2"):
        own = run(base, name, date(2024, 1, 1))
        land(spark, events(spark, (1, 1, "a"), (1, 1, "a2")), own, t)
        tool.apply(own, t)
    assert tool.table("facts").count() == 2


def test_changes_follow_the_cursor(spark, tmp_path):
    base, tool, t = str(tmp_path), Bronze(spark, str(tmp_path)), Table("dims", "mutable_dims", ("id",), changed="u", created="c")
    frame = lambda *r: spark.createDataFrame(r, "id int, u date, c date, v string")
    d = lambda n: date(2024, 1, n)
    first, second = run(base, "r1", d(5)), run(base, "r2", d(6))
    assert land(spark, frame((1, None, d(1), "a"), (2, d(2), d(1), "b")), first, t)[0]["row_count"] == 2
    state = read_state(Storage(spark), first, "dims")
    assert state["last_watermark"] == "2024-01-05T00:00:00Z" and state["last_successful_run_id"] == "r1"
    batch = land(spark, frame((1, None, d(1), "a"), (2, d(6), d(1), "B"), (3, None, d(5), "c"), (4, d(4), d(1), "old")), second, t)[0]
    assert batch["row_count"] == 2 and batch["watermark"] == {"column": "u", "from": "2024-01-05T00:00:00Z", "to": "2024-01-06T00:00:00Z"}
    tool.apply(second, t)
    assert sorted((r.id, r.v) for r in tool.table("dims").collect()) == [(1, "a"), (2, "B"), (3, "c")]


def test_last_snapshot_of_a_day_counts(spark, tmp_path):
    base, tool, t = str(tmp_path), Bronze(spark, str(tmp_path)), Table("stores", "snapshots")
    frame = lambda v: spark.createDataFrame([(1, v)], "id int, v string")
    for name, day in (("r1", 1), ("r2", 2), ("r3", 2)):
        land(spark, frame(name), run(base, name, date(2024, 1, day)), t)
    assert tool.apply(run(base, "x", date(2024, 1, 2)), t) == {"skipped": 2, "applied": 1}
    assert [r.v for r in tool.table("stores").collect()] == ["r3"]
    empty = land(spark, frame("x").limit(0), run(base, "r4", date(2024, 1, 3)), t)[0]
    assert empty["row_count"] == 0 and empty["files"] and m.faults(empty) == []


def test_failures_are_recorded_and_tried_again(spark, tmp_path):
    base, tool = str(tmp_path), Bronze(spark, str(tmp_path))
    own = run(base, "r1", date(2024, 1, 1))
    path = land(spark, events(spark, (1, 1, "a")), own, EVENTS)[0]["path"]
    storage = Storage(spark)
    text = storage.read_bytes(f"{path}/_manifest.json").decode()
    storage.write_text(f"{path}/_manifest.json", text.replace('"checks": [', '"checks": [{"status": "fail"}, '))
    assert tool.apply(own, EVENTS) == {"failed": 1}
    storage.write_text(f"{path}/_manifest.json", text)
    assert tool.apply(own, EVENTS) == {"applied": 1}
    broken = Table("events", "events", ("no such column",), event_date="at", lookback=2)
    land(spark, events(spark, (2, 2, "b")), run(base, "r2", date(2024, 1, 2)), EVENTS)
    outcome = tool.apply_all(run(base, "r2", date(2024, 1, 2)), [broken])
    assert outcome.statuses["events"] == {"failed": 1} and "events" in outcome.errors


def test_contract_version_skips_for_good(spark, tmp_path):
    base, tool = str(tmp_path), Bronze(spark, str(tmp_path))
    for name, version in (("r1", "1"), ("r2", "2")):
        own = run(base, name, date(2024, 1, 1), version)
        land(spark, events(spark, (1, 1, name)), own, EVENTS)
        tool.apply(own, EVENTS)
    assert [r.v for r in tool.table("events").collect()] == ["r1"]
    assert tool.apply(own, EVENTS) == {}


def test_json_with_mark_and_nul_bytes(spark, tmp_path):
    (tmp_path / "a.json").write_bytes(b"\xef\xbb\xbf" + json.dumps({"a": 1}).encode() + b"\0\0")
    (tmp_path / "b.json").write_bytes(b"\0\0")
    assert readers.read_json_document(spark, str(tmp_path / "a.json")) == {"a": 1}
    assert readers.read_json_document(spark, str(tmp_path / "b.json")) is None is readers.read_json_document(spark, str(tmp_path / "c.json"))


def test_dictionary_with_mark_and_dates(spark, tmp_path):
    (tmp_path / "d.csv").write_bytes('﻿id,valid_from,amount\n1,3/1/2024,"12,400"\n'.encode())
    out = readers.read_dictionary(spark, str(tmp_path / "d.csv"), "id int, valid_from date, amount double")
    assert out.collect()[0].asDict() == {"id": 1, "valid_from": date(2024, 1, 3), "amount": 12400.0}


def test_mapping_and_views(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    mapping = readers.source_mapping([{"schema": "b", "table": "t", "location": path}, {"schema": "other", "table": "u", "location": "x"}], "b")
    with pytest.raises(ValueError):
        readers.expose(spark, mapping, ["t", "missing"])
    assert readers.expose(spark, mapping, ["t"], "b_") == ["b_t"] and spark.table("b_t").count() == 3
    assert readers.pushed_query("s", "t", "a > 1") == '(SELECT * FROM "s"."t" WHERE a > 1) AS src' and readers.pushed_query("s", "t", None) == '"s"."t"'
    assert readers.has_rows(spark.range(1)) and not readers.has_rows(spark.range(0)) and readers.preview(spark.range(9), 2).count() == 2


def test_stream_applies_each_file_once(spark, tmp_path):
    folder, path, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    batch = lambda v, at, *r: events(spark, *r).withColumn("_ingest_ts", F.lit(at)).coalesce(1).write.mode("append").parquet(folder)
    batch("a", 1, (1, 1, "a"), (2, 2, "b"))
    schema = spark.read.parquet(folder).schema
    for more in (None, ((2, 2, "B"), (3, 2, "c"))):
        if more:
            batch("b", 2, *more)
        apply_stream(event_stream(spark, folder, schema), EVENTS, path, checkpoint).awaitTermination()
    assert sorted((r.id, r.v) for r in spark.read.parquet(path).collect()) == [(1, "a"), (2, "B"), (3, "c")]
