"""Silver: typed staging tables, rollups, dimensions and facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import amounts_match, money, or_zero, surrogate_key
from ..functions.predicates import touched
from ..operators.joins import lookup
from ..operators.latest import apply_time, latest_by, latest_snapshot
from ..operators.rollups import value_rollup
from .models import Context, model

RUN, APPLIED = "_bronze_last_run_id", "_bronze_last_apply_ts"


def typed(df: DataFrame, columns: str) -> DataFrame:
    """Columns cast and renamed by "name type [source], ...", with the lineage of their batch."""
    out = []
    for part in columns.split("; "):
        name, kind, *source = part.split(" ")
        out.append(F.col(source[0] if source else name).cast(kind).alias(name))
    return df.select(*out, *(F.col(c) for c in (RUN, APPLIED) if c in df.columns))


def business(df: DataFrame) -> list[str]:
    """Columns that break ties: all but those of the batch, so that equal apply times give the same row each time."""
    return [c for c in df.columns if not c.startswith("_")]


def newest(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The latest row of each key by an order that ends on the apply time."""
    return latest_by(df, keys, [*order, APPLIED], [c for c in [*business(df), RUN] if c not in {*keys, *order}])


def newest_snapshot_row(ctx: Context, df: DataFrame, keys: list[str]) -> DataFrame:
    """The last applied row of each key; keys that later snapshots lack stay unless the run wants the last snapshot only."""
    if ctx.latest_snapshot_only and "snapshot_date" in df.columns:
        df = latest_snapshot(df)
    return latest_by(df, keys, [apply_time(), RUN], [c for c in business(df) if c not in keys])


@model("staging", "product_id int, store_id smallint")
def stg_assortment(ctx: Context, b_assortment: DataFrame) -> DataFrame:
    return typed(b_assortment, "product_id int; store_id smallint")


@model("staging", "client_id int, client_full_name string, preferred_store_id smallint, registration_date date, updated_at date, is_churned boolean")
def stg_clients(ctx: Context, b_clients: DataFrame) -> DataFrame:
    rows = typed(b_clients, "client_id int id; client_full_name string fullname; preferred_store_id smallint; registration_date date; updated_at date; is_churned boolean churned")
    return newest(rows, ["client_id"], "updated_at", "registration_date")


@model("staging", "product_id int, store_id smallint, avg_cost decimal(10,2), valid_from date, valid_to date")
def stg_costing(ctx: Context, b_costing: DataFrame) -> DataFrame:
    rows = typed(b_costing, "product_id int; store_id smallint; avg_cost decimal(10,2); valid_from date; valid_to date")
    return newest(rows, ["product_id", "store_id", "valid_from"], "valid_to")


@model("staging", "zone_id smallint, delivery_type_id smallint, tariff decimal(10,2)")
def stg_delivery_costing(ctx: Context, b_delivery_costing: DataFrame) -> DataFrame:
    return typed(b_delivery_costing, "zone_id smallint; delivery_type_id smallint; tariff decimal(10,2)")


@model("staging", "delivery_resource_id int, delivery_resource_name string, delivery_type_id smallint, store_id smallint, created_at date, updated_at date, is_active boolean")
def stg_delivery_resource(ctx: Context, b_delivery_resource: DataFrame) -> DataFrame:
    columns = "delivery_resource_id int id; delivery_resource_name string fullname; delivery_type_id smallint; store_id smallint; created_at date; updated_at date; is_active boolean active_flag"
    return newest(typed(b_delivery_resource, columns), ["delivery_resource_id"], "updated_at", "created_at")


@model("staging", "order_id int, courier_id smallint, delivery_status_id smallint, delivery_status string, status_datetime timestamp_ntz")
def stg_delivery_tracking(ctx: Context, b_delivery_tracking: DataFrame) -> DataFrame:
    rows = b_delivery_tracking.where(ctx.window("status_datetime"))
    rows = typed(rows, "order_id int; courier_id smallint; delivery_status_id smallint; delivery_status string status; status_datetime timestamp_ntz")
    return newest(rows, ["order_id", "status_datetime"])


@model("staging", "delivery_type_id smallint, courier_type string")
def stg_delivery_type(ctx: Context, b_delivery_type: DataFrame) -> DataFrame:
    return typed(newest_snapshot_row(ctx, b_delivery_type, ["id"]), "delivery_type_id smallint id; courier_type string")


@model("staging", "order_id int, order_date date, product_id int, quantity decimal(10,2), sales_price decimal(10,2)")
def stg_order_product(ctx: Context, b_order_product: DataFrame) -> DataFrame:
    rows = typed(b_order_product.where(ctx.window("order_date")), "order_id int; order_date date; product_id int; quantity decimal(10,2); sales_price decimal(10,2)")
    keys = ["order_id", "product_id", "order_date"]
    return latest_by(rows, keys, [APPLIED, RUN], ["quantity", "sales_price"])


@model("staging", "order_id int, order_status_id smallint, status_datetime timestamp_ntz")
def stg_order_status_history(ctx: Context, b_order_status_history: DataFrame) -> DataFrame:
    rows = typed(b_order_status_history.where(ctx.window("status_datetime")), "order_id int; order_status_id smallint; status_datetime timestamp_ntz")
    return newest(rows, ["order_id", "status_datetime"])


@model("staging", "order_status_id smallint, order_status string")
def stg_order_statuses(ctx: Context, b_order_statuses: DataFrame) -> DataFrame:
    return typed(newest_snapshot_row(ctx, b_order_statuses, ["id"]), "order_status_id smallint id; order_status string")


@model("staging", "order_id int, client_id int, order_date date, order_source_id smallint, store_id smallint, total_amount decimal(12,4)")
def stg_orders(ctx: Context, b_orders: DataFrame, b_order_product: DataFrame, b_payments: DataFrame, b_order_status_history: DataFrame, b_delivery_tracking: DataFrame) -> DataFrame:
    """Orders of the window, and older ones that a line, payment, status or delivery of the window belongs to."""
    rows = b_orders
    if ctx.logical_date is not None:
        late = ((b_order_product, "order_date"), (b_payments, "payment_date"), (b_order_status_history, "status_datetime"), (b_delivery_tracking, "status_datetime"))
        rows = touched(b_orders, "id", ctx.window("order_date"), [df.where(ctx.window(c)) for df, c in late], "order_id")
    rows = typed(rows, "order_id int id; client_id int; order_date date; order_source_id smallint; store_id smallint; total_amount decimal(12,4)")
    return newest(rows, ["order_id"], "order_date")


@model("staging", "order_id int, payment_amount decimal(12,4), payment_method string, payment_status string, payment_date date")
def stg_payments(ctx: Context, b_payments: DataFrame) -> DataFrame:
    rows = typed(b_payments.where(ctx.window("payment_date")), "order_id int; payment_amount decimal(12,4) amount; payment_method string method; payment_status string; payment_date date")
    return newest(rows, ["order_id", "payment_date", "payment_status"])


@model("staging", "category_id smallint, category_name string")
def stg_product_categories(ctx: Context, b_product_categories: DataFrame) -> DataFrame:
    return typed(newest_snapshot_row(ctx, b_product_categories, ["id"]), "category_id smallint id; category_name string")


@model("staging", "product_id int, product_name string, unit_price decimal(10,2), unit_type string, category_id smallint, selection_weight decimal(8,2), valid_from date, valid_to date")
def stg_products(ctx: Context, b_products: DataFrame) -> DataFrame:
    columns = "product_id int id; product_name string; unit_price decimal(10,2) price; unit_type string; category_id smallint; selection_weight decimal(8,2) chance; valid_from date; valid_to date"
    return newest(typed(b_products, columns), ["product_id", "valid_from"], "valid_to")


@model("staging", "store_id smallint, city string, store_name string")
def stg_stores(ctx: Context, b_stores: DataFrame) -> DataFrame:
    return typed(newest_snapshot_row(ctx, b_stores, ["id"]), "store_id smallint id; city string; store_name string")


@model("staging", "zone_id smallint, store_id smallint, zone_name string")
def stg_zones(ctx: Context, b_zones: DataFrame) -> DataFrame:
    return typed(newest_snapshot_row(ctx, b_zones, ["id"]), "zone_id smallint id; store_id smallint; zone_name string")


@model("intermediate", "order_id int, ordered_quantity decimal(38,2), line_sales_amount decimal(38,4), line_count bigint")
def int_order_value_rollup(ctx: Context, stg_order_product: DataFrame) -> DataFrame:
    return value_rollup(stg_order_product, "order_id", "quantity", "sales_price", [APPLIED, RUN])


@model("intermediate", "order_id int, latest_order_status_id smallint, latest_order_status string, latest_status_datetime timestamp_ntz")
def int_orders_latest_status(ctx: Context, stg_order_status_history: DataFrame, stg_order_statuses: DataFrame) -> DataFrame:
    # the names are looked up for the last events only
    last = latest_by(stg_order_status_history, ["order_id"], ["status_datetime", APPLIED], ["order_status_id", RUN])
    named = lookup(last, stg_order_statuses, {"order_status_id": "order_status_id"}, {"order_status": "latest_order_status"})
    return named.withColumnsRenamed({"order_status_id": "latest_order_status_id", "status_datetime": "latest_status_datetime"})


@model("dimension", "store_id smallint, city string, store_name string", ["snapshot_dimension"])
def dim_stores(ctx: Context, stg_stores: DataFrame) -> DataFrame:
    return stg_stores.select("store_id", "city", "store_name")


@model("dimension", "zone_id smallint, store_id smallint, store_name string, store_city string, zone_name string", ["snapshot_dimension"])
def dim_zones(ctx: Context, stg_zones: DataFrame, dim_stores: DataFrame) -> DataFrame:
    return lookup(stg_zones, dim_stores, {"store_id": "store_id"}, {"store_name": "store_name", "city": "store_city"})


@model("dimension", "category_id smallint, category_name string", ["snapshot_dimension"])
def dim_product_categories(ctx: Context, stg_product_categories: DataFrame) -> DataFrame:
    return stg_product_categories.select("category_id", "category_name")


@model("dimension", "order_status_id smallint, order_status string", ["snapshot_dimension"])
def dim_order_statuses(ctx: Context, stg_order_statuses: DataFrame) -> DataFrame:
    return stg_order_statuses.select("order_status_id", "order_status")


@model("dimension", "delivery_type_id smallint, courier_type string", ["snapshot_dimension"])
def dim_delivery_type(ctx: Context, stg_delivery_type: DataFrame) -> DataFrame:
    return stg_delivery_type.select("delivery_type_id", "courier_type")


PRODUCT = "product_id int, product_name string, unit_price decimal(10,2), unit_type string, category_id smallint, category_name string, selection_weight decimal(8,2), valid_from date, valid_to date"


@model("dimension", PRODUCT, ["mutable_dimension"])
def dim_products(ctx: Context, stg_products: DataFrame, dim_product_categories: DataFrame) -> DataFrame:
    current = newest(stg_products, ["product_id"], "valid_from", "valid_to")
    return lookup(current, dim_product_categories, {"category_id": "category_id"}, ["category_name"])


@model("dimension", "assortment_key string, store_id smallint, store_name string, product_id int, product_name string, category_id smallint, category_name string", ["snapshot_dimension"])
def dim_assortment(ctx: Context, stg_assortment: DataFrame, dim_stores: DataFrame, dim_products: DataFrame) -> DataFrame:
    rows = latest_by(stg_assortment, ["store_id", "product_id"], [apply_time(), RUN], [])
    rows = lookup(rows, dim_stores, {"store_id": "store_id"}, ["store_name"])
    rows = lookup(rows, dim_products, {"product_id": "product_id"}, ["product_name", "category_id", "category_name"])
    return rows.withColumn("assortment_key", surrogate_key("store_id", "product_id"))


@model("dimension", "client_id int, client_full_name string, preferred_store_id smallint, preferred_store_name string, registration_date date, updated_at date, is_churned boolean", ["mutable_dimension"])
def dim_clients(ctx: Context, stg_clients: DataFrame, dim_stores: DataFrame) -> DataFrame:
    return lookup(stg_clients, dim_stores, {"preferred_store_id": "store_id"}, {"store_name": "preferred_store_name"})


@model("dimension", "costing_key string, product_id int, product_name string, store_id smallint, store_name string, avg_cost decimal(10,2), valid_from date, valid_to date", ["mutable_dimension"])
def dim_costing(ctx: Context, stg_costing: DataFrame, dim_products: DataFrame, dim_stores: DataFrame) -> DataFrame:
    current = newest(stg_costing, ["product_id", "store_id"], "valid_from", "valid_to")
    rows = lookup(lookup(current, dim_products, {"product_id": "product_id"}, ["product_name"]), dim_stores, {"store_id": "store_id"}, ["store_name"])
    return rows.withColumn("costing_key", surrogate_key("product_id", "store_id"))


@model("dimension", "delivery_costing_key string, zone_id smallint, zone_name string, delivery_type_id smallint, courier_type string, tariff decimal(10,2)", ["snapshot_dimension"])
def dim_delivery_costing(ctx: Context, stg_delivery_costing: DataFrame, dim_zones: DataFrame, dim_delivery_type: DataFrame) -> DataFrame:
    rows = latest_by(stg_delivery_costing, ["zone_id", "delivery_type_id"], [apply_time(), RUN], ["tariff"])
    rows = lookup(rows, dim_zones, {"zone_id": "zone_id"}, ["zone_name"])
    rows = lookup(rows, dim_delivery_type, {"delivery_type_id": "delivery_type_id"}, ["courier_type"])
    return rows.withColumn("delivery_costing_key", surrogate_key("zone_id", "delivery_type_id"))


COURIER = "delivery_resource_id int, delivery_resource_name string, delivery_type_id smallint, courier_type string, store_id smallint, store_name string, created_at date, updated_at date, is_active boolean"


@model("dimension", COURIER, ["mutable_dimension"])
def dim_delivery_resource(ctx: Context, stg_delivery_resource: DataFrame, dim_delivery_type: DataFrame, dim_stores: DataFrame) -> DataFrame:
    rows = lookup(stg_delivery_resource, dim_delivery_type, {"delivery_type_id": "delivery_type_id"}, ["courier_type"])
    return lookup(rows, dim_stores, {"store_id": "store_id"}, ["store_name"])


ORDER = (
    "order_id int, order_date date, client_id int, client_full_name string, client_is_churned boolean, store_id smallint, store_name string, order_source_id smallint, "
    "total_amount decimal(12,4), ordered_quantity decimal(38,2), line_sales_amount decimal(14,4), line_count bigint, latest_order_status_id smallint, latest_order_status string, "
    "latest_status_datetime timestamp_ntz, amount_matches_lines boolean"
)


@model("fact", ORDER, partition="order_date", keys=["order_id"])
def fact_orders(ctx: Context, stg_orders: DataFrame, dim_clients: DataFrame, dim_stores: DataFrame, int_order_value_rollup: DataFrame, int_orders_latest_status: DataFrame) -> DataFrame:
    rows = lookup(stg_orders, dim_clients, {"client_id": "client_id"}, {"client_full_name": "client_full_name", "is_churned": "client_is_churned"})
    rows = lookup(rows, dim_stores, {"store_id": "store_id"}, ["store_name"])
    rows = lookup(rows, int_order_value_rollup, {"order_id": "order_id"}, ["ordered_quantity", "line_sales_amount", "line_count"])
    rows = lookup(rows, int_orders_latest_status, {"order_id": "order_id"}, ["latest_order_status_id", "latest_order_status", "latest_status_datetime"])
    return rows.withColumns({
        "amount_matches_lines": amounts_match("total_amount", "line_sales_amount"), "ordered_quantity": or_zero("ordered_quantity").cast("decimal(38,2)"),
        "line_sales_amount": money(or_zero("line_sales_amount"), 14, 4), "line_count": or_zero("line_count"),
    })


# Columns of an order that it has in staging: other facts take them there, without the joins and rollups of fact_orders.
OF_ORDER = {"order_date": "order_date", "client_id": "client_id", "store_id": "store_id"}


@model(
    "fact",
    "fact_order_product_key string, order_id int, order_date date, client_id int, store_id smallint, product_id int, product_name string, category_id smallint, category_name string, quantity decimal(10,2), sales_price decimal(10,2), line_sales_amount decimal(14,4)",
    partition="order_date",
    keys=["fact_order_product_key"],
)
def fact_order_product(ctx: Context, stg_order_product: DataFrame, stg_orders: DataFrame, dim_products: DataFrame) -> DataFrame:
    """The key holds the line's date, the date column that of the order."""
    rows = stg_order_product.withColumn("fact_order_product_key", surrogate_key("order_id", "product_id", "order_date")).drop("order_date")
    rows = lookup(rows, stg_orders, {"order_id": "order_id"}, OF_ORDER)
    rows = lookup(rows, dim_products, {"product_id": "product_id"}, ["product_name", "category_id", "category_name"])
    return rows.withColumn("line_sales_amount", money(F.col("quantity") * F.col("sales_price"), 14, 4))


@model(
    "fact",
    "fact_payments_key string, order_id int, order_date date, client_id int, store_id smallint, payment_date date, payment_amount decimal(12,4), payment_method string, payment_status string, latest_order_status string",
    partition="payment_date",
    keys=["fact_payments_key"],
)
def fact_payments(ctx: Context, stg_payments: DataFrame, stg_orders: DataFrame, int_orders_latest_status: DataFrame) -> DataFrame:
    """An order's status counts only if the order is known."""
    rows = lookup(stg_payments, stg_orders, {"order_id": "order_id"}, OF_ORDER | {"order_id": "known order"})
    rows = lookup(rows, int_orders_latest_status, {"known order": "order_id"}, ["latest_order_status"])
    return rows.withColumn("fact_payments_key", surrogate_key("order_id", "payment_date", F.coalesce("payment_status", F.lit("unknown"))))


@model(
    "fact",
    "fact_order_status_history_key string, order_id int, order_date date, client_id int, store_id smallint, order_status_id smallint, order_status string, status_datetime timestamp_ntz",
    ["event"],
    "status_datetime",
    keys=["fact_order_status_history_key"],
)
def fact_order_status_history(ctx: Context, stg_order_status_history: DataFrame, stg_orders: DataFrame, dim_order_statuses: DataFrame) -> DataFrame:
    rows = lookup(stg_order_status_history, stg_orders, {"order_id": "order_id"}, OF_ORDER)
    rows = lookup(rows, dim_order_statuses, {"order_status_id": "order_status_id"}, ["order_status"])
    return rows.withColumn("fact_order_status_history_key", surrogate_key("order_id", "status_datetime"))


@model(
    "fact",
    "fact_delivery_tracking_key string, order_id int, order_date date, client_id int, store_id smallint, courier_id smallint, delivery_resource_name string, courier_type string, delivery_status_id smallint, delivery_status string, status_datetime timestamp_ntz",
    ["event"],
    "status_datetime",
    keys=["fact_delivery_tracking_key"],
)
def fact_delivery_tracking(ctx: Context, stg_delivery_tracking: DataFrame, stg_orders: DataFrame, dim_delivery_resource: DataFrame) -> DataFrame:
    rows = lookup(stg_delivery_tracking, stg_orders, {"order_id": "order_id"}, OF_ORDER)
    rows = lookup(rows, dim_delivery_resource, {"courier_id": "delivery_resource_id"}, ["delivery_resource_name", "courier_type"])
    return rows.withColumn("fact_delivery_tracking_key", surrogate_key("order_id", "status_datetime"))
