from datetime import UTC, date, datetime, timedelta
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lamina.functions import columns as c
from lamina.functions import predicates as p
from lamina.functions import scalars
from lamina.operators import joins, latest, quality, rollups, sets, upsert
from lamina.plans import budget
from lamina.sources import contracts

D = date


def rows(df, *names):
    return sorted((tuple(r) for r in (df.select(*names) if names else df).collect()), key=str)


def test_latest_by_puts_nulls_last_and_breaks_ties(spark):
    df = spark.createDataFrame([(1, None, "a"), (1, 5, "b"), (1, 5, "c"), (2, None, "d")], "k int, o int, v string")
    assert rows(latest.latest_by(df, ["k"], ["o"])) == [(1, 5, "c"), (2, None, "d")]


def test_latest_snapshot_and_top_per_key(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), 1), (D(2024, 1, 2), 2), (D(2024, 1, 2), 3)], "snapshot_date date, x int")
    assert rows(latest.latest_snapshot(df), "x") == [(2,), (3,)]
    left = spark.createDataFrame([(1,), (2,)], "k int")
    right = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "j int, o int, v string")
    assert rows(latest.top_per_key(left, right, "k", "j", ["o"]), "k", "v") == [(1, "b"), (2, None)]


def test_validity_join_bounds_and_overlaps(spark):
    versions = spark.createDataFrame([(1, D(2024, 1, 1), D(2024, 2, 1), 10), (1, D(2024, 2, 1), None, 20), (1, D(2024, 3, 1), D(2024, 3, 5), 30)], "k int, valid_from date, valid_to date, v int")
    days = [D(2023, 12, 31), D(2024, 1, 1), D(2024, 2, 1), D(2024, 3, 2)]
    df = spark.createDataFrame([(1, d) for d in days] + [(1, None)], "k int, at date")
    out = rows(joins.validity_join(df, versions, ["k"], "at", ["v"]), "at", "v")
    assert sorted(out, key=str) == sorted([(days[0], None), (days[1], 10), (days[2], 20), (days[3], 20), (days[3], 30), (None, None)], key=str)
    assert rows(joins.overlapping_versions(versions, ["k"]), "v") == [(30,)]


def test_lookup_keeps_clashing_names_and_fans_out(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id int, name string")
    other = spark.createDataFrame([(1, "a"), (1, "b")], "id int, name string")
    assert rows(joins.lookup(df, other, {"id": "id"}, {"name": "other"}), "id", "name", "other") == [(1, "x", "a"), (1, "x", "b"), (2, "y", None)]


@pytest.mark.parametrize(("values", "expected"), [([1], [2]), ([1, None], []), ([], [None, 1, 2])])
def test_not_in_follows_sql(spark, values, expected):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    other = spark.createDataFrame([(v,) for v in values], "x int")
    assert rows(joins.not_in(df, "k", other, "x")) == sorted([(v,) for v in expected], key=str)


def test_missing_keys_compares_nulls_and_forms(spark):
    a = spark.createDataFrame([(1, "a"), (None, "b"), (3, "c")], "k int, v string")
    b = spark.createDataFrame([("1",), (None,)], "k string")
    assert rows(joins.missing_keys(a, b, ["k"], {"k": F.col("k").cast("string")}), "v") == [("c",)]
    assert rows(sets.key_difference(a, b.select(F.col("k").cast("int").alias("k")), ["k"])) == [(3,)]


def test_sets(spark):
    a, b = spark.createDataFrame([(1, "x")], "a int, b string"), spark.createDataFrame([(2,), (2,)], "a int")
    assert rows(sets.union_filled(a, b)) == [(1, "x"), (2, None), (2, None)]
    assert sets.unique_rows(sets.concat_rows(b, b)).count() == 1


def test_columns(spark):
    df = spark.createDataFrame([(1, None, Decimal("10.00"), Decimal("10.01")), (2, "b", Decimal("0.00"), None)], "a int, b string, t decimal(12,2), l decimal(12,2)")
    assert rows(df.select(c.surrogate_key("a", "b"))) == [("1",), ("2|b",)]
    assert rows(df.select("a", c.amounts_match("t", "l"), c.share("l", "t"))) == [(1, False, Decimal("1.0010")), (2, True, None)]
    assert df.select(c.row_hash(["a", "b"])).distinct().count() == 2
    tight = spark.createDataFrame([(Decimal("1.0000"), Decimal("1.0099")), (None, Decimal("1"))], "t decimal(12,4), l decimal(12,4)")
    assert [r[0] for r in tight.select(c.amounts_match("t", "l")).collect()] == [True, None]


def test_share_is_rounded_once(spark):
    df = spark.createDataFrame([(Decimal("2298.75"), Decimal("63766.45"))], "p decimal(38,4), t decimal(12,4)")
    assert df.select(c.share("p", "t")).first()[0] == Decimal("0.0360")


def test_quality_rules_ignore_nulls(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (None, -1), (None, None), (3, 5)], "k int, n int")
    parent = spark.createDataFrame([(1,), (None,)], "id int")
    assert quality.null_rows(df, "k").count() == 2
    assert rows(quality.repeated_values(df, "k")) == [(1, 2)]
    assert rows(quality.not_positive(df, "n"), "n") == [(-1,), (0,)]
    assert rows(quality.orphans(df, "k", parent, "id"), "k") == [(3,)]
    report = quality.report([quality.Rule("m", "k", "not_null"), quality.Rule("m", "k", "relationships", "p", "id")], {"m": df, "p": parent}.__getitem__)
    assert [(r["rule"], r["broken"]) for r in report.collect()] == [("not_null", 2), ("relationships", 1)]


def test_stale(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00",), ("junk",)], "at string")
    assert not quality.stale(df, "at", datetime(2024, 1, 1, 5, tzinfo=UTC))
    assert quality.stale(df, "at", datetime(2024, 1, 1, 7, tzinfo=UTC))
    assert quality.stale(df.limit(0), "at", datetime(2024, 1, 1, tzinfo=UTC))


def test_window_has_no_upper_end(spark):
    df = spark.createDataFrame([(D(2024, 1, d),) for d in (1, 2, 3, 9, 30)], "d date")
    assert df.where(p.refresh_window("d", D(2024, 1, 9), 7)).count() == 4
    assert df.where(p.refresh_window("d", None, 7)).count() == 5


def test_cursor_ends(spark):
    days = spark.createDataFrame([(D(2024, 1, 1), None), (D(2024, 1, 3), None), (None, D(2024, 1, 2)), (None, D(2023, 1, 1)), (D(2024, 1, 4), D(2024, 1, 2))], "u date, c date")
    assert days.where(p.cursor_dates("u", "c", D(2024, 1, 1), D(2024, 1, 3))).count() == 3
    times = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 1, 1),), (datetime(2024, 1, 2),)], "u timestamp_ntz")
    assert times.where(p.cursor_times("u", None, datetime(2024, 1, 1), datetime(2024, 1, 2))).count() == 2


@given(st.dates(D(2000, 1, 1), D(2100, 1, 1)), st.integers(-3, 40))
def test_event_days_cover_the_lookback(day, lookback):
    start, end = p.event_days(day, lookback)
    assert end == day + timedelta(days=1) and (end - start).days == max(lookback, 1)


def test_touched_adds_named_rows_once(spark):
    df = spark.createDataFrame([(1, D(2020, 1, 1)), (2, D(2024, 1, 1)), (3, D(2020, 1, 1))], "id int, d date")
    late = spark.createDataFrame([(1,), (1,), (2,), (None,)], "order_id int")
    assert rows(p.touched(df, "id", F.col("d") >= D(2024, 1, 1), [late, late], "order_id"), "id") == [(1,), (2,)]


def test_merged_replaces_adds_and_keeps_nulls_apart(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    source = spark.createDataFrame([(2, "B"), (3, "C"), (None, "m")], "k int, v string")
    assert rows(upsert.merged(target, source, ["k"])) == sorted([(1, "a"), (2, "B"), (3, "C"), (None, "n"), (None, "m")], key=str)


@settings(max_examples=8, deadline=None)
@given(st.dictionaries(st.integers(0, 9), st.integers(0, 99)), st.dictionaries(st.integers(0, 9), st.integers(0, 99)))
def test_merged_is_a_dictionary_update(spark, old, new):
    make = lambda d: spark.createDataFrame([*d.items()], "k int, v int")
    assert dict(rows(upsert.merged(make(old), make(new), ["k"]))) == old | new


def test_upsert_on_files(spark, tmp_path):
    path = str(tmp_path / "t")
    frame = lambda *r: spark.createDataFrame(r, "k int, day string, v string")
    upsert.upsert(spark, frame((1, "a", "x"), (2, "b", "y")), path, ["k"], "day")
    upsert.upsert(spark, frame((1, "a", "X"), (3, "a", "z")), path, ["k"], "day")
    assert rows(spark.read.parquet(path), "k", "v") == [(1, "X"), (2, "y"), (3, "z")]
    with pytest.raises(upsert.RepeatedKeys):
        upsert.upsert(spark, frame((1, "a", "p"), (1, "a", "q")), path, ["k"], "day")
    whole = str(tmp_path / "u")
    for _ in range(2):
        upsert.upsert(spark, frame((1, "a", "x"), (2, "b", "y")), whole, ["k"])
    assert spark.read.parquet(whole).count() == 2


def test_retries():
    calls = []

    def write():
        calls.append(1)
        if len(calls) < 3:
            raise OSError

    assert upsert.with_retries(write, wait=lambda s: None) == 3
    with pytest.raises(OSError):
        upsert.with_retries(lambda: (_ for _ in ()).throw(OSError()), attempts=2, wait=lambda s: None)


def test_row_edits(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    assert rows(upsert.update_rows(df, F.col("id") == 1, {"v": F.lit("z")})) == [(1, "z"), (2, None)]
    assert rows(upsert.delete_rows(df, F.col("v") == "a"), "id") == [(2,)]
    new = spark.createDataFrame([("p",), ("o",)], "v string")
    found = rows(upsert.numbered_rows(new, df, "id", ["v"]), "id", "v")
    assert {i for i, _ in found} == {3, 4} and {v for _, v in found} == {"o", "p"} and found == rows(upsert.numbered_rows(new.repartition(3), df, "id", ["v"]), "id", "v")


@settings(max_examples=10, deadline=None)
@given(st.integers(0, 10**6), st.lists(st.integers(1, 50), min_size=1, max_size=12))
def test_allocation_loses_nothing(spark, total, sizes):
    df = spark.createDataFrame([(1, i, total, s / sum(sizes)) for i, s in enumerate(sizes)], "g int, i int, total long, w double")
    dealt = [r["n"] for r in rollups.allocate(df, ["g"], "total", "w", "i", "n").orderBy("i").collect()]
    assert sum(dealt) == total and all(abs(n - total * s / sum(sizes)) <= 1 + 1e-6 for n, s in zip(dealt, sizes, strict=True))


def test_daily_budget_keeps_totals_and_starts_late(spark):
    months = spark.createDataFrame([(D(2025, 12, 1), 80003.0, 12400000.5), (D(2026, 2, 1), 31.0, 7.0), (D(2025, 11, 1), 9.0, 9.0)], "calendar_month date, orders_budget double, sales_amount double")
    stores = spark.createDataFrame([(i, 0.2) for i in range(1, 6)], "store_id int, weight double")
    out = budget.daily(months, stores, "b")
    by = {r[0]: r for r in out.groupBy(F.month("budget_date").alias("m")).agg(F.sum("orders_budget_daily"), F.sum("sales_amount_daily"), F.min("budget_date"), F.count("*")).collect()}
    assert by[12][1] == 80003 and abs(by[12][2] - Decimal("12400000.5")) < Decimal("0.02") and by[12][3] == D(2025, 12, 16) and by[12][4] == 16 * 5
    assert by[2][1] == 31 and by[2][4] == 28 * 5 and 11 not in by


def test_profile_checksum_headers(spark):
    df = spark.createDataFrame([(1, None), (3, "b")], "a int, b string")
    assert rows(rollups.column_profile(df)) == [("a", 0, "1", "3"), ("b", 1, "b", "b")]
    files = spark.createDataFrame([("b", "2"), ("a", "1")], "path string, checksum string")
    assert rollups.batch_checksum(files).first()[0] == scalars.md5("a:1|b:2")
    lines = spark.createDataFrame([(1, 2, "x", 5), (1, 1, "y", 6)], "o int, n int, s string, v int")
    assert rows(rollups.headers(lines, "o", {"s": "s"}, {"v": "v"}, ["n"])) == [(1, "y", 11)]


def test_contracts(spark):
    df = spark.createDataFrame([(1, "2", True)], "a int, b string, extra boolean")
    contract = contracts.from_json([{"name": "b", "type": "DECIMAL(10, 2)", "position": 1}, {"name": "a", "type": "long", "position": 0, "nullable": False}, {"name": "z", "type": "uuid", "position": 2}])
    out, left = contracts.align(df, contract)
    assert out.dtypes == [("a", "bigint"), ("b", "decimal(10,2)"), ("z", "string")] and left == ["extra"] and contracts.differences(out, contract) == []
    assert contracts.differences(df, contract)
    with pytest.raises(ValueError):
        contracts.align(df, [contracts.Field("missing", "INT", False)])
    for kind in contracts.TYPES:
        assert contracts.contract_type(contracts.spark_type(kind)) == kind


def test_scalars():
    assert scalars.flag("Yes") and not scalars.flag("off") and scalars.flag("", True)
    with pytest.raises(ValueError):
        scalars.flag("maybe")
    assert scalars.flag("maybe", True) and not scalars.flag(None, False) and scalars.flag(True) and scalars.instant(" ") is None and scalars.instant(None) is None
    assert scalars.instant("2024-01-02") == datetime(2024, 1, 2, tzinfo=UTC) == scalars.instant("2024-01-02T01:00:00+01:00")
    assert scalars.iso(scalars.instant("2024-01-02T00:00:00Z")) == "2024-01-02T00:00:00Z"
    assert scalars.safe_name("a b/c:1") == "a_b_c_1"
