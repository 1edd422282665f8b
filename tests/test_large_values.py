"""Queries whose values outgrow the types that the published tables declare."""

import os
from datetime import datetime

import pyarrow as pa
import pyarrow.parquet as pq

from __spark_entry__ import SMOKE_DIR, queries
from lamina.plans.models import wide
from lamina.plans.retail import TABLES


def folder(tmp_path, **tables):
    """The smallest tables, with some of them replaced."""
    for t in TABLES:
        if t in tables:
            pq.write_table(tables[t], tmp_path / f"{t}.parquet")
        else:
            os.symlink(f"{SMOKE_DIR}/{t}.parquet", tmp_path / f"{t}.parquet")
    return str(tmp_path)


def test_wide_types_keep_the_scale():
    assert [wide(k) for k in ("decimal(12,4)", "smallint", "int", "string")] == ["decimal(38,4)", "int", "int", "string"]


def test_budgets_above_a_hundred_million(spark, tmp_path):
    prices = [60_000_000.25, 60_000_000.5, 7.0]
    orders = pq.read_table(f"{SMOKE_DIR}/orders.parquet").slice(0, 3)
    for name, values in (("o_custkey", [5, 10, 6]), ("o_totalprice", prices), ("o_orderdate", [datetime(1998, 1, 1)] * 3)):
        at = orders.schema.get_field_index(name)
        orders = orders.set_column(at, orders.schema.field(at), pa.array(values, orders.schema.field(at).type))
    rows = queries()["budget_orders_sales"](spark, folder(tmp_path, orders=orders)).collect()
    assert sorted((r.store_id, r.orders_budget_daily, r.sales_amount_daily) for r in rows) == [(0, 2.0, 120_000_000.75), (1, 1.0, 7.0)]


def test_couriers_above_the_small_integers(spark, tmp_path):
    supplier = pq.read_table(f"{SMOKE_DIR}/supplier.parquet").slice(0, 3)
    supplier = supplier.set_column(0, supplier.schema.field(0), pa.array([32_767, 32_768, 60_000], supplier.schema.field(0).type))
    out = queries()["dim_resource_mart"](spark, folder(tmp_path, supplier=supplier))
    assert out.schema["courier_id"].dataType.typeName() == "integer"
    assert sorted((r.courier_id, r.courier_type) for r in out.collect()) == [(32_767, "Bicycle"), (32_768, "Car"), (60_000, "Unmounted")]
