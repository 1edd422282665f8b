from datetime import UTC, date, datetime
from decimal import Decimal as N

import pytest
from pyspark.sql import functions as F

from lamina.plans import daily, gold, silver  # noqa: F401
from lamina.plans.models import MODELS, Build, Context, fields, ordered, select
from lamina.plans.maintenance import Metrics, compact, drop_snapshots, housekeeping_due, maintain, metrics, sweep, wants_compaction
from lamina.plans.publish import DAILY, FULL, ContractBroken, contract, publish, run_mode
from lamina.plans.rules import RULES
from lamina.sources.landing import Run

D, T = date, datetime
B = ("run-1", "2024-01-01T00:00:00")


def frame(spark, ddl, *rows):
    return spark.createDataFrame([(*r, *B) if len(r) < len(ddl.split(",")) + 2 else r for r in rows], ddl + ", _bronze_last_run_id string, _bronze_last_apply_ts string")


@pytest.fixture(scope="module")
def tables(spark):
    f = lambda ddl, *rows: frame(spark, ddl, *rows)
    day = D(2024, 1, 10)
    return {
        "stores": f("id short, city string, store_name string", (1, "A", "old", "run-0", "2023-12-31T00:00:00"), (1, "A", "One"), (2, "B", "Two", "run-2", "not a time")),
        "zones": f("id short, store_id short, zone_name string", (1, 1, "Z1"), (2, 1, "Z2"), (3, 2, "Z3")),
        "product_categories": f("id short, category_name string", (1, "C")),
        "order_statuses": f("id short, order_status string", (1, "Created"), (2, "Packing"), (3, "Delivered"), (4, "Cancelled")),
        "delivery_type": f("id short, courier_type string", (1, "Bicycle"), (2, "Car")),
        "delivery_costing": f("zone_id short, delivery_type_id short, tariff decimal(4,2)", (1, 1, N("2.00")), (2, 1, N("5.00")), (3, 2, N("9.00"))),
        "assortment": f("product_id short, store_id short", (1, 1), (1, 1), (2, 2)),
        "clients": f("id int, fullname string, preferred_store_id short, registration_date date, updated_at date, churned boolean", (1, "a", 1, day, None, False), (1, "A", 1, day, day, True), (2, "b", None, day, None, False)),
        "costing": f("product_id short, store_id short, avg_cost decimal(10,2), valid_from date, valid_to date", (1, 1, N("1.00"), D(2023, 1, 1), D(2024, 1, 1)), (1, 1, N("2.00"), D(2024, 1, 1), None), (2, 1, N("4.00"), D(2024, 1, 1), None)),
        "products": f("id int, product_name string, price decimal(10,2), unit_type string, category_id short, chance decimal(4,2), valid_from date, valid_to date", (1, "p", N("3.00"), "units", 1, N("1.00"), D(2024, 1, 1), None), (2, "q", N("6.00"), "kg", 1, N("1.00"), D(2024, 1, 1), None)),
        "delivery_resource": f("id short, fullname string, delivery_type_id short, store_id short, created_at date, updated_at date, active_flag boolean", (1, "k", 1, 1, day, None, True), (2, "l", 2, 1, day, None, True)),
        "orders": f("id int, client_id int, order_date date, order_source_id short, store_id short, total_amount decimal(12,4)", (1, 1, day, 1, 1, N("10.0000")), (2, 2, day, 1, 1, N("0.0000")), (3, 1, D(2024, 1, 1), 1, 1, N("5.0000")), (4, 9, day, 1, 1, None), (5, 1, D(2023, 6, 1), 1, 1, N("7.0000"))),
        "order_product": f("order_id int, order_date date, product_id int, quantity decimal(6,2), sales_price decimal(10,2)", (1, day, 1, N("2.00"), N("3.00")), (1, day, 2, N("1.00"), N("4.01")), (2, day, 1, N("1.00"), N("1.00")), (3, D(2024, 1, 1), 1, N("1.00"), N("5.00"))),
        "payments": f("order_id int, amount decimal(12,4), method string, payment_status string, payment_date date", (1, N("10.0000"), "card", "paid", day), (1, N("10.0000"), "card", "pending", day), (2, N("1.0000"), "cash", None, day)),
        "order_status_history": f("order_id int, order_status_id short, status_datetime timestamp_ntz", (1, 1, T(2024, 1, 10)), (1, 3, T(2024, 1, 11)), (2, 3, T(2024, 1, 10)), (3, 3, T(2024, 1, 9)), (3, 4, T(2024, 1, 10))),
        "delivery_tracking": f("order_id int, courier_id short, delivery_status_id short, status string, status_datetime timestamp_ntz", (1, 1, 1, "pick up", T(2024, 1, 10)), (1, 1, 2, "delivery", T(2024, 1, 11)), (2, 2, 2, "delivery", T(2024, 1, 10)), (3, 7, 2, "delivery", T(2024, 1, 9))),
        "budget_orders_sales": spark.createDataFrame([("b", day, 1, N("1"), N("2"))], "budget_name string, budget_date date, store_id short, orders_budget_daily decimal(12,4), sales_amount_daily decimal(12,4)"),
    }


def get(build, name, *columns):
    return sorted((tuple(r) for r in build(name).select(*columns).collect()), key=str)


def test_every_model_gives_its_declared_columns(tables):
    build = Build(tables)
    assert len(MODELS) == 45 and len(RULES) == 150
    for name in ordered():
        df = build.published(name)
        assert [c for c, _ in fields(MODELS[name])] == df.columns[: len(fields(MODELS[name]))]
        assert df.columns[-3].endswith("_build_ts")
        build.business(name).collect()


def test_dictionaries_take_the_last_applied_row(tables):
    assert get(Build(tables), "dim_stores", "store_id", "store_name") == [(1, "One"), (2, "Two")]
    assert get(Build(tables), "dim_clients", "client_id", "client_full_name", "preferred_store_name") == [(1, "A", "One"), (2, "b", None)]
    assert get(Build(tables), "dim_assortment", "assortment_key") == [("1|1",), ("2|2",)]


def test_orders_with_and_without_lines(tables):
    out = {r.order_id: r for r in Build(tables)("fact_orders").collect()}
    assert out[1].line_sales_amount == N("10.0100") and out[1].amount_matches_lines is False
    assert (out[5].ordered_quantity, out[5].line_count, out[5].latest_order_status) == (0, 0, None)
    assert out[4].amount_matches_lines is None and out[4].client_full_name is None
    assert out[3].latest_order_status == "Cancelled"


def test_keys_and_dates_of_facts(tables):
    build = Build(tables)
    assert ("1|1|2024-01-10",) in get(build, "fact_order_product", "fact_order_product_key")
    assert get(build, "fact_payments", "fact_payments_key") == [("1|2024-01-10|paid",), ("1|2024-01-10|pending",), ("2|2024-01-10|unknown",)]


def test_margin(tables):
    out = {r.order_id: r for r in Build(tables)("fct_order_margin_mart").collect()}
    assert {*out} == {1, 2}  # order 3 was cancelled after its delivery
    assert (out[1].product_cost_amount, out[1].delivery_cost_amount, out[1].gross_profit_amount, out[1].gross_margin_pct) == (N("8.0000"), N("5.0000"), N("-3.0000"), N("-0.3000"))
    assert out[2].gross_margin_pct is None and out[2].delivery_cost_amount == 0


def test_history_option_prices_old_orders(tables):
    old = lambda ctx: {r.order_id: r.avg_cost for r in Build(tables, ctx)("dim_costing_mart").where("product_id = 1").collect()}
    assert old(Context())[3] == N("2.00")
    moved = tables | {"orders": tables["orders"].withColumn("order_date", F.when(F.col("id") == 3, F.lit(D(2023, 5, 5))).otherwise(F.col("order_date")))}
    assert {r.order_id: r.avg_cost for r in Build(moved)("dim_costing_mart").where("product_id = 1").collect()}[3] is None
    assert {r.order_id: r.avg_cost for r in Build(moved, Context(full_history=True))("dim_costing_mart").where("product_id = 1").collect()}[3] == N("1.00")


def test_window_pulls_touched_orders(tables):
    build = Build(tables, Context(logical_date=D(2024, 1, 16)))
    assert get(build, "stg_orders", "order_id") == [(1,), (2,), (3,), (4,)]  # 3 by its status and delivery of the window
    assert get(Build(tables, Context(logical_date=D(2024, 1, 18))), "stg_orders", "order_id") == [(1,)]


def test_selection_and_order():
    names = ordered()
    assert names.index("stg_orders") < names.index("fct_orders_sales_mart") < names.index("fct_order_margin_mart")
    assert select(["gold"], excluded=["budget"]) and "budget_orders_sales" not in select(["gold"], excluded=["budget"])
    assert "dim_costing" in select(["mutable_dimension"]) and select(names=["fact_orders"]) == ["fact_orders"]


def test_publish_twice_is_the_same_and_daily_keeps_the_rest(spark, tables, tmp_path):
    root = str(tmp_path)
    assert run_mode(spark, root, DAILY, ["fact_orders"]) == FULL
    for _ in range(2):
        done = publish(spark, Build(tables), "fact_orders", root)
        assert done.rows == 5 and spark.read.parquet(done.path).count() == 5
    assert run_mode(spark, root, DAILY, ["fact_orders"]) == DAILY
    # order 3 alone of its day is touched; another order of that day must stay
    more = tables | {"orders": tables["orders"].unionByName(tables["orders"].where("id = 3").withColumn("id", F.lit(33)))}
    publish(spark, Build(more), "fact_orders", root)
    publish(spark, Build(tables, Context(logical_date=D(2024, 1, 16), run_id="d")), "fact_orders", root, DAILY)
    out = spark.read.parquet(done.path)
    assert sorted(r.order_id for r in out.collect()) == [1, 2, 3, 4, 5, 33]
    assert {r.order_id for r in out.where("_silver_run_id = 'd'").collect()} == {1, 2, 3, 4}
    with pytest.raises(ContractBroken):
        publish(spark, Build(tables), "fact_payments", root, DAILY)
    assert contract(MODELS["fact_orders"])[-1].name == "_silver_partition_date"


def test_daily_run(spark, tables, tmp_path):
    root, strip = str(tmp_path), ("_bronze_last_run_id", "_bronze_last_apply_ts")
    sources = {n: df.drop(*strip) for n, df in tables.items() if n != "budget_orders_sales"}
    sources["stores"] = sources["stores"].where("store_name <> 'old'")
    run = Run("r1", D(2024, 1, 11), T(2024, 1, 11, 4, tzinfo=UTC), f"{root}/raw")
    report = daily.run_daily(spark, sources, run, root, Context(logical_date=D(2024, 1, 11), run_id="r1"), extra={"budget_orders_sales": tables["budget_orders_sales"]}, strict=False)
    assert not report.bronze.errors and not report.unreadable and report.mode == FULL
    assert report.landed["orders"] == 5 and len(report.published) == 27
    assert report.broken["positive:stg_orders.total_amount"] == 1 and report.broken["relationships:stg_orders.client_id"] == 1
    margin = spark.read.parquet(f"{root}/gold/fct_order_margin")
    assert sorted(r.order_id for r in margin.collect()) == [1, 2]
    with pytest.raises(daily.ChecksFailed):
        daily.refresh(spark, Build(tables), root)


def test_maintenance(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(3):
        spark.range(n, n + 1, 1, 1).write.mode("append").parquet(path)
    assert metrics(spark, path).files == 3 and compact(spark, path).files == 1 and spark.read.parquet(path).count() == 3
    assert wants_compaction(Metrics(32, 64)) and not wants_compaction(Metrics(31, 1)) and not wants_compaction(Metrics(32, 32 * 64)) and wants_compaction(Metrics(2, 1), 0)
    spark.range(1).write.parquet(f"{path}.new-x")
    assert sweep(spark, path) == [] and sweep(spark, path, -1) == ["t.new-x"]
    assert maintain(spark, path, least_files=0).files == 1
    snapshots = str(tmp_path / "s")
    spark.createDataFrame([(1, D(2024, 1, d)) for d in (1, 2, 3)], "id int, snapshot_date date").write.partitionBy("snapshot_date").parquet(snapshots)
    assert drop_snapshots(spark, snapshots, D(2024, 1, 3)) == ["2024-01-01", "2024-01-02"] and spark.read.parquet(snapshots).count() == 1
    with pytest.raises(ValueError):
        drop_snapshots(spark, path, D(2024, 1, 3))
    assert housekeeping_due(D(2024, 1, 7)) and not housekeeping_due(D(2024, 1, 8)) and housekeeping_due(D(2024, 1, 8), True)


def test_materialised_models_are_views(spark, tables):
    build = Build(tables)
    build.materialise("dim_stores", table=True)
    build.materialise("dim_clients_mart")
    assert spark.table("dim_stores").count() == 2 and spark.table("dim_clients").columns[0] == "client_id"
    build("dim_stores").unpersist()
