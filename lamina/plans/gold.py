"""Gold: sales, delivery, cost, margin and budget marts.

A gold model reads the silver models of its own run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import money, or_zero, share
from ..operators.joins import lookup, validity_join
from .models import Context, model

#: The last status of a sale, and the delivery status of a finished delivery.
DELIVERED, BROUGHT = 3, 2


@model("gold", "budget_name string, budget_date date, store_id smallint, orders_budget_daily decimal(12,4), sales_amount_daily decimal(12,4)", ["budget", "publish"])
def budget_orders_sales(ctx: Context, b_budget_orders_sales: DataFrame) -> DataFrame:
    return b_budget_orders_sales


@model("gold", "client_id int, fullname string, preferred_store_id smallint, registration_date date, updated_at date, churned boolean", ["dimension", "publish"], alias="dim_clients")
def dim_clients_mart(ctx: Context, dim_clients: DataFrame) -> DataFrame:
    return dim_clients.withColumnsRenamed({"client_full_name": "fullname", "is_churned": "churned"})


@model("gold", "product_id int, product_name string, category_name string", ["dimension", "publish"], alias="dim_products")
def dim_products_mart(ctx: Context, dim_products: DataFrame) -> DataFrame:
    return dim_products.select("product_id", "product_name", "category_name")


@model("gold", "courier_id smallint, fullname string, courier_type string", ["dimension", "publish"], alias="dim_resource")
def dim_resource_mart(ctx: Context, dim_delivery_resource: DataFrame) -> DataFrame:
    return dim_delivery_resource.withColumnsRenamed({"delivery_resource_id": "courier_id", "delivery_resource_name": "fullname"})


@model("gold", "store_id smallint, city string, store_name string, zone_name string", ["dimension", "publish"], alias="dim_stores")
def dim_stores_mart(ctx: Context, dim_stores: DataFrame, dim_zones: DataFrame) -> DataFrame:
    """A row for each zone of a store."""
    return lookup(dim_stores, dim_zones, {"store_id": "store_id"}, ["zone_name"])


@model("gold", "order_id int, order_date date, product_id int, quantity decimal(10,2), store_id smallint, avg_cost decimal(10,2), total_cost decimal(18,4)", ["allocation", "publish"], "order_date", "dim_costing")
def dim_costing_mart(ctx: Context, fact_order_product: DataFrame, dim_costing: DataFrame, stg_costing: DataFrame) -> DataFrame:
    """Cost of each line by the version that was valid: of current versions only, or of all if the run wants history."""
    lines = fact_order_product.where(ctx.window("order_date")).select("order_id", "order_date", "product_id", "quantity", "store_id")
    rows = validity_join(lines, stg_costing if ctx.full_history else dim_costing, ["product_id", "store_id"], "order_date", ["avg_cost"])
    return rows.withColumn("total_cost", money(F.col("quantity") * F.col("avg_cost")))


@model("gold", "order_id int, tariff decimal(10,2)", ["helper", "publish"], alias="dim_delivery_cost")
def dim_delivery_cost_mart(ctx: Context, stg_delivery_tracking: DataFrame, dim_delivery_resource: DataFrame, dim_zones: DataFrame, dim_delivery_costing: DataFrame) -> DataFrame:
    """The dearest tariff that the courier has in any zone of the courier's store.

    Tariffs are rolled up to couriers first: the deliveries, which are many, meet one row each, and are read without
    what the fact adds to them.
    """
    couriers = lookup(dim_delivery_resource.select("delivery_resource_id", "store_id", "delivery_type_id"), dim_zones, {"store_id": "store_id"}, ["zone_id"])
    priced = lookup(couriers, dim_delivery_costing, {"zone_id": "zone_id", "delivery_type_id": "delivery_type_id"}, ["tariff"])
    dearest = priced.groupBy("delivery_resource_id").agg(F.max("tariff").alias("tariff"))
    brought = stg_delivery_tracking.where(F.col("delivery_status_id") == BROUGHT)
    return lookup(brought, dearest, {"courier_id": "delivery_resource_id"}, ["tariff"]).groupBy("order_id").agg(F.max("tariff").alias("tariff"))


@model("gold", "order_id int, courier_id smallint, delivery_status_id smallint, status string, status_datetime timestamp_ntz", ["event", "publish"], "status_datetime", "fct_deliveries")
def fct_deliveries_mart(ctx: Context, fact_delivery_tracking: DataFrame) -> DataFrame:
    return fact_delivery_tracking.where(ctx.window("status_datetime")).withColumnRenamed("delivery_status", "status")


@model("gold", "order_id int, store_id smallint, client_id int, order_date date, order_source_id smallint, total_amount decimal(12,4)", ["fact", "publish"], "order_date", "fct_orders_sales")
def fct_orders_sales_mart(ctx: Context, stg_orders: DataFrame, int_orders_latest_status: DataFrame) -> DataFrame:
    """Of the columns of an order, those that it has in staging, without the joins and rollups of fact_orders."""
    rows = lookup(stg_orders.where(ctx.window("order_date")), int_orders_latest_status, {"order_id": "order_id"}, ["latest_order_status_id"])
    return rows.where(F.col("latest_order_status_id") == DELIVERED)


@model("gold", "order_id int, product_id int, store_id smallint, order_date date, line_sales_amount decimal(14,4)", ["fact", "publish"])
def fct_order_product(ctx: Context, fact_order_product: DataFrame, stg_orders: DataFrame, int_orders_latest_status: DataFrame) -> DataFrame:
    """Lines of delivered orders that are known: their status comes from its own model, without the joins of fact_orders."""
    delivered = int_orders_latest_status.where(F.col("latest_order_status_id") == DELIVERED).select("order_id")
    known = delivered.join(stg_orders.select(F.col("order_id").alias("known")), F.col("order_id") == F.col("known"), "left_semi").withColumnRenamed("order_id", "sold")
    return fact_order_product.join(known, F.col("order_id") == F.col("sold"), "left_semi")


MARGIN = "order_id int, order_date date, client_id int, store_id smallint, total_amount decimal(12,4), product_cost_amount decimal(18,4), delivery_cost_amount decimal(18,4), gross_profit_amount decimal(18,4), gross_margin_pct decimal(10,4)"


@model("gold", MARGIN, ["fact", "publish"], "order_date", "fct_order_margin")
def fct_order_margin_mart(ctx: Context, fct_orders_sales_mart: DataFrame, dim_costing_mart: DataFrame, dim_delivery_cost_mart: DataFrame) -> DataFrame:
    cost = dim_costing_mart.groupBy("order_id").agg(F.sum("total_cost").alias("product_cost"))
    delivery = dim_delivery_cost_mart.groupBy("order_id").agg(F.sum("tariff").alias("delivery_cost"))
    # sales are rows of fact_orders, so its store is theirs
    rows = lookup(lookup(fct_orders_sales_mart, cost, {"order_id": "order_id"}, ["product_cost"]), delivery, {"order_id": "order_id"}, ["delivery_cost"])
    profit = F.col("total_amount") - or_zero("product_cost") - or_zero("delivery_cost")
    return rows.withColumns({
        "product_cost_amount": money(or_zero("product_cost")), "delivery_cost_amount": money(or_zero("delivery_cost")),
        "gross_profit_amount": money(profit), "gross_margin_pct": share(profit, "total_amount"),
    })
