"""SQL for DuckDB that states independently what each model holds, over the retail views."""

from __future__ import annotations

import re

from .models import MODELS, fields
from .retail import BRONZE

_A, _R = "_bronze_last_apply_ts", "_bronze_last_run_id"


def first(source: str, keys: str, order: str, columns: str = "*") -> str:
    """The first row of each key, all order items descending with nulls last."""
    by = ", ".join(f"{o.strip()} DESC NULLS LAST" for o in order.split(",") if o.strip())
    return f"SELECT DISTINCT ON ({keys}) {columns} FROM {source} ORDER BY {keys}, {by}"


def _dictionary(table: str, columns: str, text: str) -> str:
    return f"SELECT {columns} FROM ({first(f'b_{table}', 'id', f'TRY_CAST({_A} AS TIMESTAMP), {_R}, {text}')})"


CHECKS = {
    "stg_assortment": "SELECT * FROM b_assortment",
    "stg_delivery_costing": f"SELECT zone_id, delivery_type_id, CAST(tariff AS DECIMAL(10,2)) AS tariff, {_A}, {_R} FROM b_delivery_costing",
    "stg_clients": "SELECT id AS client_id, fullname AS client_full_name, preferred_store_id, registration_date, updated_at, churned AS is_churned FROM (" + first("b_clients", "id", f"updated_at, registration_date, {_A}") + ")",
    "stg_costing": first("b_costing", "product_id, store_id, valid_from", f"valid_to, {_A}"),
    "stg_delivery_resource": "SELECT id AS delivery_resource_id, fullname AS delivery_resource_name, delivery_type_id, store_id, created_at, updated_at, active_flag AS is_active FROM (" + first("b_delivery_resource", "id", f"updated_at, created_at, {_A}") + ")",
    "stg_delivery_tracking": "SELECT order_id, courier_id, delivery_status_id, status AS delivery_status, status_datetime FROM (" + first("b_delivery_tracking", "order_id, status_datetime", f"{_A}, courier_id, delivery_status_id, status") + ")",
    "stg_delivery_type": _dictionary("delivery_type", "id AS delivery_type_id, courier_type", "courier_type"),
    "stg_order_product": first("(SELECT * REPLACE (CAST(quantity AS DECIMAL(10,2)) AS quantity) FROM b_order_product)", "order_id, product_id, order_date", f"{_A}, {_R}, quantity, sales_price"),
    "stg_order_status_history": first("b_order_status_history", "order_id, status_datetime", f"{_A}, order_status_id"),
    "stg_order_statuses": _dictionary("order_statuses", "id AS order_status_id, order_status", "order_status"),
    "stg_orders": "SELECT id AS order_id, client_id, order_date, order_source_id, store_id, CAST(total_amount AS DECIMAL(12,4)) AS total_amount FROM (" + first("b_orders", "id", f"order_date, {_A}") + ")",
    "stg_payments": "SELECT order_id, CAST(amount AS DECIMAL(12,4)) AS payment_amount, method AS payment_method, payment_status, payment_date FROM (" + first("b_payments", "order_id, payment_date, payment_status", f"{_A}, amount, method") + ")",
    "stg_product_categories": _dictionary("product_categories", "id AS category_id, category_name", "category_name"),
    "stg_products": f"SELECT id AS product_id, product_name, price AS unit_price, unit_type, category_id, chance AS selection_weight, valid_from, valid_to, {_A} FROM (" + first("b_products", "id, valid_from", f"valid_to, {_A}") + ")",
    "stg_stores": _dictionary("stores", "id AS store_id, city, store_name", "store_name"),
    "stg_zones": _dictionary("zones", "id AS zone_id, store_id, zone_name", "zone_name"),
    "int_order_value_rollup": "SELECT order_id, sum(quantity) AS ordered_quantity, sum(quantity * sales_price) AS line_sales_amount, count(*) AS line_count FROM stg_order_product GROUP BY ALL",
    "int_orders_latest_status": f"""SELECT h.order_id, h.order_status_id AS latest_order_status_id, s.order_status AS latest_order_status, h.status_datetime AS latest_status_datetime
        FROM ({first("stg_order_status_history", "order_id", f"status_datetime, {_A}, order_status_id")}) AS h LEFT JOIN stg_order_statuses AS s USING (order_status_id)""",
    "dim_stores": "FROM stg_stores",
    "dim_zones": "SELECT z.*, s.store_name, s.city AS store_city FROM stg_zones AS z LEFT JOIN dim_stores AS s USING (store_id)",
    "dim_product_categories": "FROM stg_product_categories",
    "dim_order_statuses": "FROM stg_order_statuses",
    "dim_delivery_type": "FROM stg_delivery_type",
    "dim_products": "SELECT p.*, c.category_name FROM (" + first("stg_products", "product_id", f"valid_from, valid_to, {_A}") + ") AS p LEFT JOIN dim_product_categories AS c USING (category_id)",
    "dim_assortment": f"""SELECT a.store_id || '|' || a.product_id AS assortment_key, a.store_id, s.store_name, a.product_id, p.product_name, p.category_id, p.category_name
        FROM ({first("stg_assortment", "store_id, product_id", f"TRY_CAST({_A} AS TIMESTAMP), {_R}")}) AS a LEFT JOIN dim_stores AS s USING (store_id) LEFT JOIN dim_products AS p USING (product_id)""",
    "dim_clients": "SELECT c.*, s.store_name AS preferred_store_name FROM stg_clients AS c LEFT JOIN dim_stores AS s ON s.store_id = c.preferred_store_id",
    "dim_costing": f"""SELECT c.product_id || '|' || c.store_id AS costing_key, c.product_id, p.product_name, c.store_id, s.store_name, c.avg_cost, c.valid_from, c.valid_to
        FROM ({first("stg_costing", "product_id, store_id", f"valid_from, valid_to, {_A}")}) AS c LEFT JOIN dim_products AS p USING (product_id) LEFT JOIN dim_stores AS s USING (store_id)""",
    "dim_delivery_costing": f"""SELECT c.zone_id || '|' || c.delivery_type_id AS delivery_costing_key, c.zone_id, z.zone_name, c.delivery_type_id, t.courier_type, c.tariff
        FROM ({first("stg_delivery_costing", "zone_id, delivery_type_id", f"TRY_CAST({_A} AS TIMESTAMP), {_R}, tariff")}) AS c LEFT JOIN dim_zones AS z USING (zone_id) LEFT JOIN dim_delivery_type AS t USING (delivery_type_id)""",
    "dim_delivery_resource": "SELECT r.*, t.courier_type, s.store_name FROM stg_delivery_resource AS r LEFT JOIN dim_delivery_type AS t USING (delivery_type_id) LEFT JOIN dim_stores AS s USING (store_id)",
    "fact_orders": """SELECT o.*, c.client_full_name, c.is_churned AS client_is_churned, s.store_name, ifnull(v.ordered_quantity, 0) AS ordered_quantity, ifnull(v.line_sales_amount, 0) AS line_sales_amount,
        ifnull(v.line_count, 0) AS line_count, l.latest_order_status_id, l.latest_order_status, l.latest_status_datetime,
        o.total_amount - ifnull(v.line_sales_amount, 0) BETWEEN -0.0099 AND 0.0099 AS amount_matches_lines
        FROM stg_orders AS o LEFT JOIN dim_clients AS c USING (client_id) LEFT JOIN dim_stores AS s ON s.store_id = o.store_id LEFT JOIN int_order_value_rollup AS v ON v.order_id = o.order_id LEFT JOIN int_orders_latest_status AS l ON l.order_id = o.order_id""",
    "fact_order_product": """SELECT op.order_id || '|' || op.product_id || '|' || op.order_date AS fact_order_product_key, op.order_id, o.order_date, o.client_id, o.store_id, op.product_id, p.product_name, p.category_id, p.category_name,
        op.quantity, op.sales_price, op.quantity * op.sales_price AS line_sales_amount FROM stg_order_product AS op LEFT JOIN fact_orders AS o ON o.order_id = op.order_id LEFT JOIN dim_products AS p ON p.product_id = op.product_id""",
    "fact_payments": """SELECT p.order_id || '|' || p.payment_date || '|' || ifnull(p.payment_status, 'unknown') AS fact_payments_key, p.*, o.order_date, o.client_id, o.store_id, o.latest_order_status
        FROM stg_payments AS p LEFT JOIN fact_orders AS o USING (order_id)""",
    "fact_order_status_history": """SELECT h.order_id || '|' || h.status_datetime AS fact_order_status_history_key, h.order_id, o.order_date, o.client_id, o.store_id, h.order_status_id, s.order_status, h.status_datetime
        FROM stg_order_status_history AS h LEFT JOIN fact_orders AS o USING (order_id) LEFT JOIN dim_order_statuses AS s ON s.order_status_id = h.order_status_id""",
    "fact_delivery_tracking": """SELECT t.order_id || '|' || t.status_datetime AS fact_delivery_tracking_key, t.*, o.order_date, o.client_id, o.store_id, r.delivery_resource_name, r.courier_type
        FROM stg_delivery_tracking AS t LEFT JOIN fact_orders AS o USING (order_id) LEFT JOIN dim_delivery_resource AS r ON r.delivery_resource_id = t.courier_id""",
    "budget_orders_sales": "FROM b_budget_orders_sales",
    "dim_clients_mart": "SELECT * RENAME (client_full_name AS fullname, is_churned AS churned) FROM dim_clients",
    "dim_products_mart": "FROM dim_products",
    "dim_resource_mart": "SELECT delivery_resource_id AS courier_id, delivery_resource_name AS fullname, courier_type FROM dim_delivery_resource",
    "dim_stores_mart": "SELECT s.*, z.zone_name FROM dim_stores AS s LEFT JOIN dim_zones AS z USING (store_id)",
    "dim_costing_mart": """SELECT f.order_id, f.order_date, f.product_id, f.quantity, f.store_id, c.avg_cost, f.quantity * c.avg_cost AS total_cost FROM fact_order_product AS f
        LEFT JOIN dim_costing AS c ON c.product_id = f.product_id AND c.store_id = f.store_id AND f.order_date >= c.valid_from AND f.order_date < ifnull(c.valid_to, DATE '9999-01-01')""",
    "dim_delivery_cost_mart": """SELECT t.order_id, max(c.tariff) AS tariff FROM fact_delivery_tracking AS t LEFT JOIN dim_delivery_resource AS r ON r.delivery_resource_id = t.courier_id
        LEFT JOIN dim_zones AS z ON z.store_id = r.store_id LEFT JOIN dim_delivery_costing AS c ON c.zone_id = z.zone_id AND c.delivery_type_id = r.delivery_type_id WHERE t.delivery_status_id = 2 GROUP BY ALL""",
    "fct_deliveries_mart": "SELECT * RENAME (delivery_status AS status) FROM fact_delivery_tracking",
    "fct_orders_sales_mart": "FROM fact_orders WHERE latest_order_status_id = 3",
    "fct_order_product": "FROM fact_order_product WHERE order_id IN (SELECT order_id FROM fact_orders WHERE latest_order_status_id = 3)",
    "fct_order_margin_mart": """SELECT s.order_id, s.order_date, s.client_id, s.store_id, s.total_amount, ifnull(c.cost, 0) AS product_cost_amount, ifnull(d.tariff, 0) AS delivery_cost_amount,
        s.total_amount - ifnull(c.cost, 0) - ifnull(d.tariff, 0) AS gross_profit_amount,
        CAST((s.total_amount - ifnull(c.cost, 0) - ifnull(d.tariff, 0)) AS DOUBLE) / nullif(CAST(s.total_amount AS DOUBLE), 0) AS gross_margin_pct FROM fct_orders_sales_mart AS s
        LEFT JOIN (SELECT order_id, sum(total_cost) AS cost FROM dim_costing_mart GROUP BY ALL) AS c USING (order_id) LEFT JOIN dim_delivery_cost_mart AS d USING (order_id)""",
}


def _cast(name: str, kind: str) -> str:
    """A column in the declared type; decimals as doubles of that scale, as results are compared by value."""
    if kind.startswith("decimal"):
        return f"CAST(CAST({name} AS {kind}) AS DOUBLE) AS {name}"
    return f"CAST({name} AS {({'smallint': 'INT', 'timestamp_ntz': 'TIMESTAMP', 'string': 'VARCHAR'}).get(kind, kind)}) AS {name}"


def chain(name: str, replaced: dict[str, str] | None = None) -> str:
    """WITH clauses for everything that a model's check reads, and the model itself."""
    texts = CHECKS | {f"b_{t}": sql for t, sql in BRONZE.items()} | (replaced or {})
    done: dict[str, str] = {}

    def visit(n: str) -> None:
        if n not in done:
            for word in sorted(set(re.findall(r"\w+", texts[n]))):
                if word in texts and word != n:
                    visit(word)
            done[n] = texts[n]

    visit(name)
    return "WITH " + ", ".join(f"{n} AS MATERIALIZED ({sql})" for n, sql in done.items())


def check_sql(name: str, replaced: dict[str, str] | None = None) -> str:
    """SQL for a model's business columns."""
    return f"{chain(name, replaced)} SELECT {', '.join(_cast(c, kind) for c, kind in fields(MODELS[name]))} FROM {name}"
