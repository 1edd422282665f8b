"""Daily budgets of stores from monthly ones."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rollups import allocate
from ..operators.upsert import append, replace_keys, replace_table
from ..sources.readers import read_dictionary
from ..sources.storage import Storage

#: The first day with a budget, and the parts of a unit of money that sales are dealt in.
START, SCALE = "2025-12-16", 1_000_000


def monthly(spark: SparkSession, path: str) -> DataFrame:
    """(calendar_month, orders_budget, sales_amount) from the planning file."""
    return read_dictionary(spark, path, "calendar_month date, orders_budget double, avg_order_value_budget double, sales_amount double").select("calendar_month", "orders_budget", "sales_amount")


def daily(months: DataFrame, stores: DataFrame, name: str, start: str = START, scale: int = SCALE) -> DataFrame:
    """(budget_name, budget_date, store_id, orders_budget_daily, sales_amount_daily).

    months: (calendar_month, orders_budget, sales_amount); stores: (store_id, weight), weights adding up to 1. A
    month's whole total goes to its days from the start on: to stores first, then evenly to days. Orders are whole,
    sales are dealt in parts of a unit; nothing is lost.
    """
    first = F.greatest("calendar_month", F.lit(start).cast("date"))
    active = months.withColumns({"first day": first, "last day": F.last_day("calendar_month"), "orders": F.rint("orders_budget").cast("long"), "sales": F.rint(F.col("sales_amount") * scale).cast("long")})
    # months and stores are a plan's few rows
    dealt = active.where(F.col("first day") <= F.col("last day")).crossJoin(F.broadcast(stores))
    for c in ("orders", "sales"):
        dealt = allocate(dealt, ["calendar_month"], c, "weight", "store_id", f"{c} of store")
    days = dealt.withColumn("budget_date", F.explode(F.sequence("first day", "last day")))
    days = days.withColumn("even", F.lit(1.0) / (F.datediff("last day", "first day") + 1))
    for c in ("orders", "sales"):
        days = allocate(days, ["calendar_month", "store_id"], f"{c} of store", "even", "budget_date", f"{c} of day")
    amount = (F.col("sales of day").cast("decimal(20,0)") / F.lit(scale)).cast("decimal(12,4)")
    return days.select(F.lit(name).alias("budget_name"), "budget_date", F.col("store_id").cast("smallint").alias("store_id"), F.col("orders of day").cast("decimal(12,4)").alias("orders_budget_daily"), amount.alias("sales_amount_daily"))


def load(spark: SparkSession, rows: DataFrame, path: str, names: Iterable[str]) -> None:
    """Put budgets of some names in place of those that a table has of them."""
    if not Storage(spark).exists(path):
        append(rows, path)
        return
    replace_table(spark, replace_keys(spark.read.parquet(path), rows, "budget_name", names), path)
