"""Queries of every operator over the driver's tables, and their SQL for DuckDB.

Models run over the retail views. Other operators run over the tables as they are. Decimals are handed out as
doubles of their scale, as results are compared by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import UTC, date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import columns as c
from ..functions import predicates as p
from ..operators import joins, latest, quality, rollups, sets, upsert
from ..sources import contracts
from ..sources.groups import Table
from ..sources.landing import Run, land
from ..sources.readers import read_files, with_file_facts
from ..sources.storage import Storage
from . import budget, gold, silver  # noqa: F401  they register the models
from .bronze import Bronze
from .checks import chain, check_sql
from .models import MODELS, Build, Context
from .publish import publish
from .retail import bronze

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: A logical date in the middle of the orders, for windows.
DAY = date(1998, 7, 1)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, small integers as integers."""

    def kind(t: T.DataType) -> str | None:
        return "double" if isinstance(t, T.DecimalType) else "int" if isinstance(t, T.ShortType) else None

    return df.select(*(F.col(f"`{f.name}`").cast(kind(f.dataType)).alias(f.name) if kind(f.dataType) else F.col(f"`{f.name}`") for f in df.schema))


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) as the query of its name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = lambda spark, sf_dir: plain(f(spark, sf_dir))
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A folder of its own under the shared one that the session names, or the warehouse."""
    root = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/lamina-{uuid.uuid4().hex}"


def _model(name: str) -> Query:
    return lambda spark, sf_dir: plain(Build(bronze(spark, sf_dir)).values(name))


for _name in MODELS:
    QUERIES[_name], SQL[_name] = _model(_name), check_sql(_name)

_IN = f"DATE '{DAY.isoformat()}' - INTERVAL 7 DAY"
_WINDOWED = {
    "stg_orders": f"""(SELECT id AS order_id, client_id, order_date, order_source_id, store_id, CAST(total_amount AS DECIMAL(12,4)) AS total_amount FROM (SELECT DISTINCT ON (id) * FROM b_orders
        WHERE order_date >= {_IN} OR id IN (SELECT order_id FROM b_order_product WHERE order_date >= {_IN} UNION SELECT order_id FROM b_payments WHERE payment_date >= {_IN}
        UNION SELECT order_id FROM b_order_status_history WHERE CAST(status_datetime AS DATE) >= {_IN} UNION SELECT order_id FROM b_delivery_tracking WHERE CAST(status_datetime AS DATE) >= {_IN})
        ORDER BY id, order_date DESC NULLS LAST, _bronze_last_apply_ts DESC NULLS LAST))""",
    "stg_payments": f"(SELECT order_id, CAST(amount AS DECIMAL(12,4)) AS payment_amount, method AS payment_method, payment_status, payment_date FROM (SELECT DISTINCT ON (order_id, payment_date, payment_status) * FROM b_payments WHERE payment_date >= {_IN} ORDER BY order_id, payment_date, payment_status, _bronze_last_apply_ts DESC, amount DESC))",
}


def _daily(name: str) -> Query:
    return lambda spark, sf_dir: plain(Build(bronze(spark, sf_dir), Context(logical_date=DAY)).values(name))


for _name, _sql in _WINDOWED.items():
    QUERIES[f"{_name}_daily"], SQL[f"{_name}_daily"] = _daily(_name), check_sql(_name, {_name: f"FROM {_sql}"})


_LINE = "l_orderkey, l_linenumber"


@query(f"SELECT DISTINCT ON ({_LINE}) {_LINE}, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate FROM lineitem ORDER BY {_LINE}, l_shipdate DESC, l_extendedprice DESC, l_partkey DESC, l_suppkey DESC")
def latest_line_dedup(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")
    return latest.latest_by(rows, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_extendedprice"], ["l_partkey", "l_suppkey"])


@query("SELECT user_id, event_type, ts FROM (SELECT DISTINCT ON (user_id) user_id, event_type, ts FROM events ORDER BY user_id, ts DESC, event_id DESC)")
def latest_status_per_user(spark, sf_dir):
    return latest.latest_by(table(spark, sf_dir, "events").select("user_id", "event_type", "ts", "event_id"), ["user_id"], ["ts", "event_id"], []).drop("event_id")


@query("SELECT event_id, ts, event_type FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-20' - INTERVAL 7 DAY")
def window_refresh_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts", "event_type").where(p.refresh_window("ts", date(2024, 1, 20), 7))


_CURSOR = "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderdate END AS changed, o_orderdate + INTERVAL 30 DAY AS created FROM orders"


@query(f"WITH s AS (SELECT o_orderkey, CAST(changed AS DATE) AS changed, CAST(created AS DATE) AS created FROM ({_CURSOR})) SELECT o_orderkey FROM s WHERE changed BETWEEN DATE '1998-06-01' AND DATE '1998-07-01' OR (changed IS NULL AND created BETWEEN DATE '1998-06-15' AND DATE '1998-07-01')")
def cursor_extract_date(spark, sf_dir):
    rows = _cursor_rows(spark, sf_dir).select("o_orderkey", F.to_date("changed").alias("changed"), F.to_date("created").alias("created"))
    return rows.where(p.cursor_dates("changed", "created", date(1998, 6, 1), date(1998, 7, 1), date(1998, 6, 15))).select("o_orderkey")


@query(f"SELECT o_orderkey FROM ({_CURSOR}) WHERE (changed > TIMESTAMP '1998-06-01' AND changed <= TIMESTAMP '1998-07-01') OR (changed IS NULL AND created > TIMESTAMP '1998-06-01' AND created <= TIMESTAMP '1998-07-01')")
def cursor_extract_ts(spark, sf_dir):
    return _cursor_rows(spark, sf_dir).where(p.cursor_times("changed", "created", datetime(1998, 6, 1), datetime(1998, 7, 1))).select("o_orderkey")


def _cursor_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "orders")
    changed = F.when(F.col("o_orderkey") % 3 == 0, None).otherwise(F.col("o_orderdate"))
    return rows.select("o_orderkey", changed.alias("changed"), (F.col("o_orderdate") + F.expr("INTERVAL 30 DAY")).alias("created"))


@query("SELECT event_id, ts FROM events WHERE ts >= DATE '2024-01-11' AND ts < DATE '2024-01-13'")
def event_date_window(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "ts").where(p.event_window("ts", date(2024, 1, 12), 2))


_LATE = "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-01' OR o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-06-24')"


@query(_LATE)
def late_touch_closure(spark, sf_dir):
    late = table(spark, sf_dir, "lineitem").where(F.col("l_shipdate") >= datetime(2001, 6, 24))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return p.touched(rows, "o_orderkey", F.col("o_orderdate") >= datetime(2001, 7, 1), [late], "l_orderkey")


@query("SELECT c_custkey, c_name, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def dim_lookup_left(spark, sf_dir):
    rows = joins.lookup(table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation"), {"c_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"])
    return joins.lookup(rows, table(spark, sf_dir, "region"), {"n_regionkey": "r_regionkey"}, ["r_name"]).select("c_custkey", "c_name", "n_name", "r_name")


_MONEY = "CAST(l_quantity AS DECIMAL(10,2)) * CAST(l_extendedprice AS DECIMAL(12,2))"


def _lines(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return rows.select("l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", F.col("l_quantity").cast("decimal(10,2)").alias("quantity"), F.col("l_extendedprice").cast("decimal(12,2)").alias("price"))


@query(f"SELECT l_orderkey, CAST(sum(CAST(l_quantity AS DECIMAL(10,2))) AS DOUBLE) AS ordered_quantity, CAST(sum({_MONEY}) AS DOUBLE) AS line_sales_amount, count(*) AS line_count FROM lineitem GROUP BY l_orderkey")
def order_value_rollup(spark, sf_dir):
    return rollups.value_rollup(_lines(spark, sf_dir), "l_orderkey", "quantity", "price")


@query(
    f"""WITH v AS (SELECT l_orderkey, sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS amount, count(*) AS n FROM lineitem GROUP BY 1)
    SELECT o_orderkey, c_name, n_name, CAST(ifnull(amount, 0) AS DOUBLE) AS amount, ifnull(n, 0) AS line_count, abs(CAST(o_totalprice AS DECIMAL(12,2)) - ifnull(amount, 0)) < 0.01 AS amount_matches_lines
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN v ON l_orderkey = o_orderkey"""
)
def fact_orders_enriched(spark, sf_dir):
    lines = _lines(spark, sf_dir).groupBy("l_orderkey").agg(F.sum("price").alias("amount"), F.count("*").alias("n"))
    rows = joins.lookup(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer"), {"o_custkey": "c_custkey"}, ["c_name", "c_nationkey"])
    rows = joins.lookup(rows, table(spark, sf_dir, "nation"), {"c_nationkey": "n_nationkey"}, ["n_name"])
    rows = joins.lookup(rows, lines, {"o_orderkey": "l_orderkey"}, ["amount", "n"])
    total = F.col("o_totalprice").cast("decimal(12,2)")
    return rows.select("o_orderkey", "c_name", "n_name", c.or_zero("amount").alias("amount"), c.or_zero("n").alias("line_count"), c.amounts_match(total, "amount").alias("amount_matches_lines"))


@query(f"SELECT l_orderkey, l_linenumber, o_custkey, p_name, CAST({_MONEY} AS DOUBLE) AS line_sales_amount FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN part ON l_partkey = p_partkey")
def fact_line_enriched(spark, sf_dir):
    rows = joins.lookup(_lines(spark, sf_dir), table(spark, sf_dir, "orders"), {"l_orderkey": "o_orderkey"}, ["o_custkey"])
    rows = joins.lookup(rows, table(spark, sf_dir, "part"), {"l_partkey": "p_partkey"}, ["p_name"])
    return rows.select("l_orderkey", "l_linenumber", "o_custkey", "p_name", c.money(F.col("quantity") * F.col("price"), 22, 4).alias("line_sales_amount"))


@query("SELECT concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(CAST(o_orderdate AS DATE) AS VARCHAR), CASE WHEN o_orderkey % 2 = 0 THEN NULL ELSE o_orderstatus END) AS key FROM orders")
def surrogate_keys(spark, sf_dir):
    part = F.when(F.col("o_orderkey") % 2 == 0, None).otherwise(F.col("o_orderstatus"))
    return table(spark, sf_dir, "orders").select(c.surrogate_key("o_orderkey", F.to_date("o_orderdate"), part).alias("key"))


_VERSIONS = """SELECT p_partkey, CAST(p_size AS DECIMAL(10,2)) AS cost, DATE '1995-01-01' AS valid_from, DATE '1998-01-01' AS valid_to FROM part
    UNION ALL SELECT p_partkey, CAST(p_size + 1 AS DECIMAL(10,2)) AS cost, DATE '1998-01-01' AS valid_from, CAST(NULL AS DATE) AS valid_to FROM part WHERE p_partkey % 3 = 0"""


@query(
    f"""WITH v AS ({_VERSIONS}) SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_shipdate AS DATE) AS shipped, CAST(cost AS DOUBLE) AS cost FROM lineitem
    LEFT JOIN v ON l_partkey = p_partkey AND CAST(l_shipdate AS DATE) >= valid_from AND (valid_to IS NULL OR CAST(l_shipdate AS DATE) < valid_to)"""
)
def validity_range_join(spark, sf_dir):
    table(spark, sf_dir, "part").createOrReplaceTempView("part")
    versions = spark.sql(_VERSIONS).withColumnRenamed("p_partkey", "l_partkey")
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.to_date("l_shipdate").alias("shipped"))
    return joins.validity_join(rows, versions, ["l_partkey"], "shipped", ["cost"])


@query(f"WITH v AS ({_VERSIONS}), w AS (FROM v UNION ALL SELECT p_partkey, cost, DATE '1997-06-01', DATE '1997-07-01' FROM v WHERE p_partkey % 10 = 0 AND valid_to IS NOT NULL) SELECT a.p_partkey, a.valid_from FROM w AS a WHERE EXISTS (FROM w AS b WHERE b.p_partkey = a.p_partkey AND b.valid_from < a.valid_from AND a.valid_from < ifnull(b.valid_to, DATE '9999-12-31'))")
def overlapping_versions(spark, sf_dir):
    table(spark, sf_dir, "part").createOrReplaceTempView("part")
    versions = spark.sql(_VERSIONS)
    more = versions.where("p_partkey % 10 = 0 and valid_to is not null").withColumns({"valid_from": F.lit(date(1997, 6, 1)), "valid_to": F.lit(date(1997, 7, 1))})
    return joins.overlapping_versions(sets.concat_rows(versions, more), ["p_partkey"]).select("p_partkey", "valid_from")


@query(
    """SELECT o_orderkey, CAST(max(CAST(s_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS tariff FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON s_nationkey = c_nationkey
    WHERE o_orderstatus = 'F' GROUP BY o_orderkey"""
)
def fanout_max_tariff(spark, sf_dir):
    """The greatest balance of any supplier in the customer's nation; suppliers are rolled up to nations before the join."""
    best = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.max(F.col("s_acctbal").cast("decimal(12,2)")).alias("tariff"))
    rows = joins.lookup(table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey"), table(spark, sf_dir, "customer"), {"o_custkey": "c_custkey"}, ["c_nationkey"])
    return joins.lookup(rows, best, {"c_nationkey": "s_nationkey"}, ["tariff"]).groupBy("o_orderkey").agg(F.max("tariff").alias("tariff"))


@query("SELECT r_regionkey, r_name, n_name FROM region LEFT JOIN nation ON n_regionkey = r_regionkey")
def store_zone_fanout(spark, sf_dir):
    return joins.lookup(table(spark, sf_dir, "region"), table(spark, sf_dir, "nation"), {"r_regionkey": "n_regionkey"}, ["n_name"]).select("r_regionkey", "r_name", "n_name")


@query("SELECT l_orderkey, l_linenumber, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'")
def outer_to_inner(spark, sf_dir):
    rows = joins.lookup(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), table(spark, sf_dir, "orders"), {"l_orderkey": "o_orderkey"}, ["o_orderstatus"])
    return rows.where("o_orderstatus = 'F'")


_COST = "CAST(l_quantity AS DECIMAL(10,2)) * CAST(p_retailprice AS DECIMAL(10,2))"


@query(
    f"""WITH cost AS (SELECT l_orderkey, sum({_COST}) AS cost FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1)
    SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12,4)) AS DOUBLE) AS total_amount, CAST(CAST(ifnull(cost, 0) AS DECIMAL(18,4)) AS DOUBLE) AS product_cost_amount,
    CAST(CAST(CAST(o_totalprice AS DECIMAL(12,4)) - ifnull(cost, 0) AS DECIMAL(18,4)) AS DOUBLE) AS gross_profit_amount,
    CAST(CAST(CAST(CAST(o_totalprice AS DECIMAL(12,4)) - ifnull(cost, 0) AS DOUBLE) / nullif(o_totalprice, 0) AS DECIMAL(10,4)) AS DOUBLE) AS gross_margin_pct
    FROM orders LEFT JOIN cost ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'"""
)
def order_margin(spark, sf_dir):
    """Cost, profit and margin of finished orders."""
    lines = joins.lookup(_lines(spark, sf_dir), table(spark, sf_dir, "part").withColumn("unit cost", F.col("p_retailprice").cast("decimal(10,2)")), {"l_partkey": "p_partkey"}, ["unit cost"])
    cost = lines.groupBy("l_orderkey").agg(F.sum(F.col("quantity") * F.col("unit cost")).alias("cost"))
    rows = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_orderkey", F.col("o_totalprice").cast("decimal(12,4)").alias("total_amount"))
    rows = joins.lookup(rows, cost, {"o_orderkey": "l_orderkey"}, ["cost"])
    profit = F.col("total_amount") - c.or_zero("cost")
    return rows.select("o_orderkey", "total_amount", c.money(c.or_zero("cost")).alias("product_cost_amount"), c.money(profit).alias("gross_profit_amount"), c.share(profit, "total_amount").alias("gross_margin_pct"))


@query(
    " UNION ALL ".join(
        f"SELECT '{x}' AS column_name, count(*) FILTER ({x} IS NULL) AS null_count, CAST(min({x}) AS VARCHAR) AS min_value, CAST(max({x}) AS VARCHAR) AS max_value FROM orders" for x in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    )
)
def column_profile(spark, sf_dir):
    return rollups.column_profile(table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"])


@query("SELECT o_orderkey, sha256(concat_ws('||', CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderkey % 5 = 0 THEN '<NULL>' ELSE o_orderstatus END, o_orderpriority)) AS row_hash FROM orders")
def row_hash(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderstatus")).alias("o_orderstatus"), "o_orderpriority")
    return rows.select("o_orderkey", c.row_hash(["o_orderkey", "o_orderstatus", "o_orderpriority"]).alias("row_hash"))


@query("SELECT DISTINCT CAST(ts AS DATE) AS event_date FROM events")
def distinct_event_dates(spark, sf_dir):
    return rollups.distinct_days(table(spark, sf_dir, "events"), "ts")


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier")
def union_by_name_fill(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return sets.union_filled(a, table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("id")))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def missing_keys_anti(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return sets.key_difference(table(spark, sf_dir, "orders"), lines, ["o_orderkey"])


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'O')")
def not_in_anti(spark, sf_dir):
    return joins.not_in(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", table(spark, sf_dir, "orders").where("o_orderstatus <> 'O'"), "o_custkey")


@query("SELECT count(*) AS n FROM customer WHERE c_custkey NOT IN (SELECT CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END FROM orders)")
def not_in_with_nulls(spark, sf_dir):
    other = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")).alias("k"))
    return joins.not_in(table(spark, sf_dir, "customer"), "c_custkey", other, "k").agg(F.count("*").alias("n"))


@query("SELECT p_partkey FROM (SELECT p_partkey, CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_brand END AS brand FROM part) WHERE brand IS NULL")
def dq_not_null(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 10 != 0, F.col("p_brand")).alias("brand"))
    return quality.null_rows(rows, "brand").select("p_partkey")


@query("SELECT l_orderkey || '|' || l_linenumber AS value, count(*) AS n FROM lineitem GROUP BY 1 HAVING count(*) > 1")
def dq_unique(spark, sf_dir):
    return quality.repeated_values(table(spark, sf_dir, "lineitem").withColumn("key", c.surrogate_key("l_orderkey", "l_linenumber")), "key")


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal <= 0")
def dq_positive(spark, sf_dir):
    return quality.not_positive(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), "c_acctbal")


@query("SELECT c_custkey FROM customer WHERE c_custkey % 7 <> 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def dq_relationships(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 7 != 0, F.col("c_custkey")).alias("k"))
    return quality.orphans(rows, "k", table(spark, sf_dir, "orders").where("o_orderstatus = 'P'"), "o_custkey").select("c_custkey")


_CHANGED = "SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice FROM orders WHERE o_orderkey % 4 = 0 UNION ALL SELECT -o_orderkey, 'N', o_totalprice FROM orders WHERE o_orderkey % 100 = 0 AND o_orderkey > 0"


@query(f"WITH n AS ({_CHANGED}) SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM n) UNION ALL FROM n")
def merge_upsert(spark, sf_dir):
    base = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    base.createOrReplaceTempView("orders_to_merge")
    return upsert.merged(base, spark.sql(_CHANGED.replace("FROM orders", "FROM orders_to_merge")), ["o_orderkey"])


_REPLACED = "year(o_orderdate) = 1998"


@query(f"SELECT o_orderkey, year(o_orderdate) AS order_year, CASE WHEN {_REPLACED} THEN 'again' ELSE 'first' END AS version FROM orders WHERE NOT ({_REPLACED} AND o_orderkey % 2 = 0)")
def partition_replace(spark, sf_dir):
    """A year's partition replaced by fewer rows, others as they were."""
    path = f"{scratch(spark)}/orders"
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").cast("long").alias("order_year"))
    upsert.replace_partitions(rows.withColumn("version", F.lit("first")), path, "order_year")
    upsert.replace_partitions(rows.where("order_year = 1998 and o_orderkey % 2 <> 0").withColumn("version", F.lit("again")), path, "order_year")
    return spark.read.parquet(path).select("o_orderkey", F.col("order_year").cast("long").alias("order_year"), "version")


@query("WITH s AS (SELECT p_partkey, p_name, DATE '2024-01-01' + CAST(p_partkey % 3 AS INT) AS snapshot_date FROM part) SELECT p_partkey, p_name FROM s WHERE snapshot_date = (SELECT max(snapshot_date) FROM s)")
def snapshot_latest(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_name", F.date_add(F.lit(date(2024, 1, 1)), (F.col("p_partkey") % 3).cast("int")).alias("snapshot_date"))
    return latest.latest_snapshot(rows).drop("snapshot_date")


@query("SELECT c_custkey, o.o_orderkey FROM customer LEFT JOIN LATERAL (SELECT o_orderkey FROM orders WHERE o_custkey = c_custkey ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1) AS o ON true")
def top1_lateral(spark, sf_dir):
    best = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return latest.top_per_key(table(spark, sf_dir, "customer").select("c_custkey"), best, "c_custkey", "o_custkey", ["o_orderdate", "o_orderkey"]).select("c_custkey", "o_orderkey")


_SHARE = """SELECT *, total * w AS raw, floor(total * w) AS base FROM (SELECT n_regionkey AS g, n_nationkey AS i, 1000003 AS total, (n_nationkey + 1.0::DOUBLE) / sum(n_nationkey + 1.0::DOUBLE) OVER (PARTITION BY n_regionkey) AS w FROM nation)"""


@query(f"SELECT g, i, CAST(base + CASE WHEN row_number() OVER (PARTITION BY g ORDER BY raw - base DESC, i) <= total - sum(base) OVER (PARTITION BY g) THEN 1 ELSE 0 END AS BIGINT) AS dealt FROM ({_SHARE})")
def integer_allocation(spark, sf_dir):
    size = (F.col("i") + 1).cast("double")
    rows = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("g"), F.col("n_nationkey").alias("i"), F.lit(1000003).alias("total"))
    return rollups.allocate(rows.withColumn("w", size / F.sum(size).over(W.partitionBy("g"))), ["g"], "total", "w", "i", "dealt").select("g", "i", "dealt")


_MONTHS = "SELECT DATE '2025-12-01' AS m, 80003 AS o UNION ALL SELECT DATE '2026-01-01', 31007 UNION ALL SELECT DATE '2026-02-01', 5 UNION ALL SELECT DATE '2025-11-01', 9"


@query(
    f"""WITH m AS ({_MONTHS}), a AS (SELECT m, o, greatest(m, DATE '2025-12-16') AS f, last_day(m) AS l FROM m WHERE last_day(m) >= DATE '2025-12-16'),
    s AS (SELECT a.*, n_nationkey AS store_id, o * 0.04::DOUBLE AS raw FROM a CROSS JOIN nation),
    t AS (SELECT *, CAST(floor(raw) + CASE WHEN row_number() OVER (PARTITION BY m ORDER BY raw - floor(raw) DESC, store_id) <= o - sum(floor(raw)) OVER (PARTITION BY m) THEN 1 ELSE 0 END AS BIGINT) AS n FROM s),
    d AS (SELECT *, CAST(unnest(generate_series(f, l, INTERVAL 1 DAY)) AS DATE) AS budget_date, n * (1.0::DOUBLE / (date_diff('day', f, l) + 1)) AS r FROM t)
    SELECT store_id, budget_date, CAST(floor(r) + CASE WHEN row_number() OVER (PARTITION BY m, store_id ORDER BY r - floor(r) DESC, budget_date) <= n - sum(floor(r)) OVER (PARTITION BY m, store_id) THEN 1 ELSE 0 END AS DOUBLE) AS orders_budget_daily FROM d"""
)
def budget_allocation(spark, sf_dir):
    months = spark.sql(f"SELECT m AS calendar_month, CAST(o AS DOUBLE) AS orders_budget, CAST(o * 10 AS DOUBLE) AS sales_amount FROM ({_MONTHS})")
    stores = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("store_id"), F.lit(0.04).alias("weight"))
    return budget.daily(months, stores, "check").select("store_id", "budget_date", "orders_budget_daily")


@query("SELECT l_orderkey, min_by(l_partkey, (l_linenumber, l_shipdate, l_partkey)) AS first_part, CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS amount FROM lineitem GROUP BY l_orderkey")
def order_headers(spark, sf_dir):
    return rollups.headers(_lines(spark, sf_dir), "l_orderkey", {"first_part": "l_partkey"}, {"amount": "price"}, ["l_linenumber", "l_shipdate", "l_partkey"])


@query("SELECT md5(string_agg(CAST(n_nationkey AS VARCHAR) || ':' || n_name, '|' ORDER BY CAST(n_nationkey AS VARCHAR) || ':' || n_name)) AS checksum FROM nation")
def batch_checksum(spark, sf_dir):
    files = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("path"), F.col("n_name").alias("checksum"))
    return rollups.batch_checksum(files)


@query("SELECT CAST(r_regionkey AS INT) AS r_regionkey, r_name, CAST(NULL AS VARCHAR) AS note, CAST(CAST(r_regionkey AS DECIMAL(10,2)) AS DOUBLE) AS rate FROM region")
def contract_alignment(spark, sf_dir):
    contract = [contracts.Field("r_regionkey", "INT", False), contracts.Field("r_name", "STRING"), contracts.Field("note", "STRING"), contracts.Field("rate", "DECIMAL(10,2)")]
    return contracts.align(table(spark, sf_dir, "region").withColumn("rate", F.col("r_regionkey")).withColumn("extra", F.lit(1)), contract)[0]


def _landing(spark: SparkSession) -> tuple[str, Callable[[str, date], Run]]:
    root = scratch(spark)
    return root, lambda name, day: Run(name, day, datetime(day.year, day.month, day.day, 4, tzinfo=UTC), f"{root}/raw")


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def raw_roundtrip(spark, sf_dir):
    """A table landed as a batch, and read by the files that its manifest lists."""
    _, run = _landing(spark)
    said = land(spark, table(spark, sf_dir, "nation"), run("r1", date(2024, 1, 1)), Table("nation", "snapshots"))[0]
    return read_files(spark, said).select("n_nationkey", "n_name", "n_regionkey")


@query("SELECT event_id, CAST(ts AS DATE) AS event_date, CASE WHEN ts >= TIMESTAMP '2024-01-29' THEN value + 1 ELSE value END AS value FROM events WHERE ts < TIMESTAMP '2024-01-31'")
def bronze_apply(spark, sf_dir):
    """Events landed for all days, and again changed for the last two: applied once each, the later version last."""
    root, run = _landing(spark)
    kind = Table("events", "events", ("event_id",), event_date="ts", lookback=2)
    rows, tool = table(spark, sf_dir, "events").where("ts < '2024-01-31'").select("event_id", "ts", "value"), Bronze(spark, root)
    for name, day, source in (("r1", date(2024, 1, 30), rows), ("r2", date(2024, 1, 30), rows.withColumn("value", F.col("value") + 1))):
        own = run(name, day)
        land(spark, source, own, kind)
        tool.apply_all(own, [kind], strict=True)
        tool.apply_all(own, [kind], strict=True)  # finds nothing left to do
    return tool.table("events").select("event_id", "event_date", "value")


@query(f"{chain('fct_orders_sales_mart')} SELECT order_id, order_date FROM fct_orders_sales_mart WHERE order_date >= DATE '2001-06-24'")
def publish_partitioned(spark, sf_dir):
    """A mart's days of a daily run published as partitions, and read back."""
    done = publish(spark, Build(bronze(spark, sf_dir), Context(logical_date=date(2001, 7, 1))), "fct_orders_sales_mart", scratch(spark))
    return spark.read.parquet(done.path).select("order_id", "order_date")


@query("SELECT r_regionkey, r_name FROM region")
def file_lineage_join(spark, sf_dir):
    """Rows joined with the facts of the file that each comes from."""
    path = f"{scratch(spark)}/region"
    table(spark, sf_dir, "region").repartition(2).write.parquet(path)
    facts = spark.createDataFrame([(e.path, e.name) for e in Storage(spark).parts(path)], "path string, name string")
    return with_file_facts(spark.read.parquet(path), facts).where("name is not null").select("r_regionkey", "r_name")


FLAGSHIP = "order_margin"
