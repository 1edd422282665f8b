"""The data-quality rules of the models, as fixed values."""

from __future__ import annotations

from ..operators.quality import Rule

#: Model: (columns never null, columns without repeated values, columns above 0, references column=model.column).
CHECKS = {
    "stg_stores": ("store_id store_name city", "store_id", "", ""),
    "stg_zones": ("zone_id store_id", "zone_id", "", "store_id=stg_stores.store_id"),
    "stg_product_categories": ("category_id category_name", "category_id", "", ""),
    "stg_order_statuses": ("order_status_id order_status", "order_status_id", "", ""),
    "stg_delivery_type": ("delivery_type_id courier_type", "delivery_type_id", "", ""),
    "stg_delivery_costing": ("zone_id delivery_type_id tariff", "", "tariff", "zone_id=stg_zones.zone_id delivery_type_id=stg_delivery_type.delivery_type_id"),
    "stg_assortment": ("product_id store_id", "", "", "store_id=stg_stores.store_id"),
    "stg_clients": ("client_id client_full_name", "client_id", "", ""),
    "stg_delivery_resource": ("delivery_resource_id delivery_type_id", "delivery_resource_id", "", "delivery_type_id=stg_delivery_type.delivery_type_id"),
    "stg_products": ("product_id category_id unit_price", "", "unit_price", "category_id=stg_product_categories.category_id"),
    "stg_costing": ("product_id store_id avg_cost", "", "avg_cost", "product_id=stg_products.product_id store_id=stg_stores.store_id"),
    "stg_orders": ("order_id client_id store_id total_amount", "order_id", "total_amount", "client_id=stg_clients.client_id store_id=stg_stores.store_id"),
    "stg_order_product": ("order_id product_id quantity sales_price", "", "quantity sales_price", "order_id=stg_orders.order_id product_id=stg_products.product_id"),
    "stg_payments": ("order_id payment_amount payment_date", "", "payment_amount", "order_id=stg_orders.order_id"),
    "stg_order_status_history": ("order_id order_status_id status_datetime", "", "", "order_id=stg_orders.order_id order_status_id=stg_order_statuses.order_status_id"),
    "stg_delivery_tracking": ("order_id status_datetime", "", "", "order_id=stg_orders.order_id"),
    "int_orders_latest_status": ("order_id latest_order_status_id latest_status_datetime", "order_id", "", ""),
    "int_order_value_rollup": ("order_id ordered_quantity line_sales_amount", "order_id", "ordered_quantity line_sales_amount", ""),
    "dim_stores": ("store_id store_name", "store_id", "", ""),
    "dim_zones": ("zone_id store_id", "zone_id", "", "store_id=dim_stores.store_id"),
    "dim_product_categories": ("category_id", "category_id", "", ""),
    "dim_order_statuses": ("order_status_id", "order_status_id", "", ""),
    "dim_delivery_type": ("delivery_type_id", "delivery_type_id", "", ""),
    "dim_delivery_costing": ("delivery_costing_key tariff", "delivery_costing_key", "tariff", ""),
    "dim_assortment": ("assortment_key", "assortment_key", "", ""),
    "dim_clients": ("client_id", "client_id", "", "preferred_store_id=dim_stores.store_id"),
    "dim_delivery_resource": ("delivery_resource_id store_id", "delivery_resource_id", "", "store_id=dim_stores.store_id"),
    "dim_products": ("product_id category_id unit_price", "product_id", "unit_price", "category_id=dim_product_categories.category_id"),
    "dim_costing": ("costing_key avg_cost", "costing_key", "avg_cost", ""),
    "fact_orders": ("order_id client_id store_id total_amount", "order_id", "total_amount", "client_id=dim_clients.client_id store_id=dim_stores.store_id"),
    "fact_order_product": ("fact_order_product_key order_id product_id", "fact_order_product_key", "", "order_id=fact_orders.order_id product_id=dim_products.product_id"),
    "fact_payments": ("fact_payments_key order_id payment_amount", "fact_payments_key", "payment_amount", "order_id=fact_orders.order_id"),
    "fact_order_status_history": ("fact_order_status_history_key order_id order_status_id", "fact_order_status_history_key", "", "order_id=fact_orders.order_id order_status_id=dim_order_statuses.order_status_id"),
    "fact_delivery_tracking": ("fact_delivery_tracking_key order_id", "fact_delivery_tracking_key", "", "order_id=fact_orders.order_id courier_id=dim_delivery_resource.delivery_resource_id"),
}


def _rules() -> list[Rule]:
    out = []
    for model, (filled, unique, positive, references) in CHECKS.items():
        for kind, columns in (("not_null", filled), ("unique", unique), ("positive", positive)):
            out += [Rule(model, c, kind) for c in columns.split()]
        for text in references.split():
            column, _, parent = text.partition("=")
            out.append(Rule(model, column, "relationships", *parent.split(".")))
    return out


RULES = _rules()
