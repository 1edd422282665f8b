"""A synthetic retail source: its first tables, and what each day changes in them.

All draws are hashes of a seed and of the row that they are for, so a run gives the same rows however Spark deals
them out. Nothing is collected: a day of a large shop is generated where its rows are.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.joins import lookup, not_in
from ..operators.latest import latest_by
from ..operators.rollups import headers
from ..operators.upsert import numbered_rows, update_rows

#: Fixed values of the shop.
CITIES = ("Adelaide", "Brisbane", "Canberra", "Darwin", "Sydney")
ZONES = (5, 5, 5, 4, 5)
STATUSES = ("Created", "Packing", "Delivered", "Cancelled")
COURIERS = ("Unmounted", "Bicycle", "Car")
CATEGORIES = ("Bakery", "Dairy", "Drinks", "Fish", "Frozen", "Fruit", "Meat", "Sweets", "Vegetables")
PRODUCTS, BY_WEIGHT = 72, 21
ORDERS_A_WEEK, LEAST_LINES, MOST_LINES = 1.8, 5, 20
CREATED, PACKING, DELIVERED, CANCELLED = 1, 2, 3, 4


def uniform(seed: int, *of: str | Column) -> Column:
    """A number from 0 up to 1 for each row, by what it is for."""
    return F.pmod(F.xxhash64(F.lit(seed), *of), F.lit(1 << 53)) / F.lit(float(1 << 53))


def beta(seed: int, a: int, b: int, *of: str | Column) -> Column:
    """A number with a beta distribution of whole parameters: the a-th least of a + b - 1 uniform ones."""
    return F.sort_array(F.array(*(uniform(seed * 1000 + i, *of) for i in range(a + b - 1))))[a - 1]


def scaled_beta(seed: int, low: float, high: float, a: int, b: int, *of: str | Column) -> Column:
    return F.lit(low) + (high - low) * beta(seed, a, b, *of)


def weighted_choice(df: DataFrame, group: list[str], weight: str, number: str, seed: int, *of: str) -> DataFrame:
    """As many rows of each group as its number says, drawn without replacement by weight."""
    key = -F.log(uniform(seed, *group, *of) + 1e-18) / F.col(weight)
    return df.withColumn("draw", F.row_number().over(W.partitionBy(*group).orderBy(key))).where(F.col("draw") <= F.col(number)).drop("draw")


def first_tables(spark: SparkSession, day: date, clients: int = 20_000, couriers: int = 700, seed: int = 1) -> dict[str, DataFrame]:
    """The shop on its first day, without orders."""
    numbered = lambda values: [(i + 1, v) for i, v in enumerate(values)]
    frame = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    stores = frame([(i, c, f"Store {c}") for i, c in numbered(CITIES)], "id smallint, city string, store_name string")
    zones = [(s + 1, z + 1) for s, n in enumerate(ZONES) for z in range(n)]
    today, ids = F.lit(day), spark.range(1, PRODUCTS + 1).select(F.col("id").cast("int").alias("id"))
    products = ids.select(
        "id", F.concat(F.lit("Product "), "id").alias("product_name"), scaled_beta(seed, 1, 40, 2, 5, "id").cast("decimal(10,2)").alias("price"),
        F.when(F.col("id") <= BY_WEIGHT, "kg").otherwise("units").alias("unit_type"), (F.col("id") % len(CATEGORIES) + 1).cast("smallint").alias("category_id"),
        (uniform(seed + 1, "id") + 0.1).cast("decimal(4,2)").alias("chance"), today.alias("valid_from"), F.lit(None).cast("date").alias("valid_to"),
    )
    offered = products.crossJoin(stores.select(F.col("id").alias("store_id")))  # 72 products in five stores
    people = lambda n: spark.range(1, n + 1).select(F.col("id").cast("int").alias("id"))
    store_of = (F.floor(uniform(seed + 2, "id") * len(CITIES)) + 1).cast("smallint")
    empty = lambda ddl: frame([], ddl)
    return {
        "stores": stores,
        "zones": frame([(i + 1, s, f"Zone {s}-{z}") for i, (s, z) in enumerate(zones)], "id smallint, store_id smallint, zone_name string"),
        "product_categories": frame(numbered(CATEGORIES), "id smallint, category_name string"),
        "order_statuses": frame(numbered(STATUSES), "id smallint, order_status string"),
        "delivery_type": frame(numbered(COURIERS), "id smallint, courier_type string"),
        "delivery_costing": frame([(z + 1, t + 1, 3.0 + z % 5 + 2 * t) for z in range(len(zones)) for t in range(3)], "zone_id smallint, delivery_type_id smallint, tariff double").withColumn("tariff", F.col("tariff").cast("decimal(4,2)")),
        "assortment": offered.select(F.col("id").cast("smallint").alias("product_id"), "store_id"),
        "costing": offered.select(F.col("id").cast("smallint").alias("product_id"), "store_id", (F.col("price") * (0.5 + 0.2 * uniform(seed + 3, "id", "store_id"))).cast("decimal(10,2)").alias("avg_cost"), "valid_from", "valid_to"),
        "products": products,
        "clients": people(clients).select("id", F.concat(F.lit("Client "), "id").alias("fullname"), store_of.alias("preferred_store_id"), today.alias("registration_date"), F.lit(None).cast("date").alias("updated_at"), F.lit(False).alias("churned")),
        "delivery_resource": people(couriers).select(F.col("id").cast("smallint").alias("id"), F.concat(F.lit("Courier "), "id").alias("fullname"), (F.col("id") % 3 + 1).cast("smallint").alias("delivery_type_id"), store_of.alias("store_id"), today.alias("created_at"), F.lit(None).cast("date").alias("updated_at"), F.lit(True).alias("active_flag")),
        "orders": empty("id int, client_id int, order_date date, order_source_id smallint, store_id smallint, total_amount decimal(12,4)"),
        "order_product": empty("order_id int, order_date date, product_id int, quantity decimal(6,2), sales_price decimal(10,2)"),
        "payments": empty("order_id int, amount decimal(12,4), method string, payment_status string, payment_date date"),
        "order_status_history": empty("order_id int, order_status_id smallint, status_datetime timestamp_ntz"),
        "delivery_tracking": empty("order_id int, courier_id smallint, delivery_status_id smallint, status string, status_datetime timestamp_ntz"),
    }


def _at(day: date, hour: int, seed: int, *of: str) -> Column:
    """An instant of a day within an hour."""
    return F.expr(f"TIMESTAMP_NTZ '{day.isoformat()} {hour:02d}:00:00'") + F.make_dt_interval(F.lit(0), F.lit(0), F.floor(uniform(seed, *of) * 60).cast("int"))


def next_day(tables: dict[str, DataFrame], day: date, seed: int, churn: float = 0.002, new_clients: int = 20, repriced: float = 0.01) -> dict[str, DataFrame]:
    """The tables after a day: new, changed and lost clients, prices, orders, and the progress of orders of before."""
    t, now = dict(tables), F.lit(day)
    t["clients"] = update_rows(t["clients"], (~F.col("churned")) & (uniform(seed, "id", F.lit("churn")) < churn), {"updated_at": now, "churned": F.lit(True)})
    spark = t["clients"].sparkSession
    joined = spark.range(new_clients).select(F.col("id").alias("n"), (F.pmod("id", F.lit(len(CITIES))) + 1).cast("smallint").alias("preferred_store_id"))
    added = numbered_rows(joined, t["clients"], "id", ["n"]).select("id", F.concat(F.lit("Client "), "id").alias("fullname"), "preferred_store_id", now.alias("registration_date"), F.lit(None).cast("date").alias("updated_at"), F.lit(False).alias("churned"))
    t["clients"] = t["clients"].unionByName(added)
    # a new price closes a version and opens another
    change = F.col("valid_to").isNull() & (F.col("valid_from") < now) & (uniform(seed, "id", F.lit("price")) < repriced)
    opened = t["products"].where(change).withColumns({"price": (F.col("price") * 1.1).cast("decimal(10,2)"), "valid_from": now})
    t["products"] = update_rows(t["products"], change, {"valid_to": now}).unionByName(opened)

    buyers = t["clients"].where(~F.col("churned") & (uniform(seed, "id", F.lit("buys")) < ORDERS_A_WEEK / 7)).select(F.col("id").alias("client_id"), F.col("preferred_store_id").alias("store_id"))
    orders = numbered_rows(buyers, t["orders"], "id", ["client_id"])
    wanted = F.floor(scaled_beta(seed, LEAST_LINES, MOST_LINES + 1, 2, 4, "id")).cast("int")
    goods = t["products"].where("valid_to is null").select(F.col("id").alias("product_id"), "price", "chance", "unit_type")
    offered = t["assortment"].select("store_id", F.col("product_id").cast("int").alias("product_id")).join(F.broadcast(goods), "product_id")  # the shop's products, of fixed number
    basket = weighted_choice(orders.withColumn("lines", wanted).join(F.broadcast(offered), "store_id"), ["id"], "chance", "lines", seed, "product_id")
    some = uniform(seed, "id", "product_id", F.lit("quantity"))
    quantity = F.when(F.col("unit_type") == "kg", F.round(0.2 + some * 2, 2)).otherwise(F.floor(1 + some * 4)).cast("decimal(6,2)")
    lines = basket.select(F.col("id").alias("order_id"), now.alias("order_date"), "product_id", quantity.alias("quantity"), F.col("price").alias("sales_price"), "client_id", "store_id")
    lines = lines.withColumn("amount", F.round(F.col("quantity") * F.col("sales_price"), 2))
    heads = headers(lines, "order_id", {"client_id": "client_id", "store_id": "store_id", "order_date": "order_date"}, {"total_amount": "amount"}, ["product_id"])
    source = (F.pmod(F.col("order_id"), F.lit(3)) + 1).cast("smallint")
    t["orders"] = t["orders"].unionByName(heads.select(F.col("order_id").cast("int").alias("id"), "client_id", "order_date", source.alias("order_source_id"), "store_id", F.col("total_amount").cast("decimal(12,4)").alias("total_amount")))
    t["order_product"] = t["order_product"].unionByName(lines.select("order_id", "order_date", "product_id", "quantity", "sales_price"))

    # orders of before go a step further; those of today are created
    last = tables["order_status_history"].groupBy("order_id").agg(F.max("order_status_id").alias("status"))
    packing = last.where(F.col("status") == CREATED).select("order_id", F.when(uniform(seed, "order_id", F.lit("cancel")) < 0.03, CANCELLED).otherwise(PACKING).alias("status"))
    arriving = last.where(F.col("status") == PACKING).select("order_id", F.lit(DELIVERED).alias("status"))
    steps = heads.select("order_id", F.lit(CREATED).alias("status")).unionByName(packing).unionByName(arriving)
    hour = F.col("status").cast("int")
    stamped = steps.withColumn("at", F.when(hour == CREATED, _at(day, 9, seed, "order_id")).when(hour == PACKING, _at(day, 7, seed, "order_id")).otherwise(_at(day, 12, seed, "order_id")))
    t["order_status_history"] = t["order_status_history"].unionByName(stamped.select("order_id", F.col("status").cast("smallint").alias("order_status_id"), F.col("at").alias("status_datetime")))

    # a delivered order is paid once, and one courier of its store brought it
    of_order = tables["orders"].select(F.col("id").alias("order_id"), "total_amount", "store_id")
    unpaid = not_in(arriving, "order_id", t["payments"].where("payment_status = 'paid'"), "order_id")
    paid = lookup(unpaid, of_order, {"order_id": "order_id"}, ["total_amount"])
    t["payments"] = t["payments"].unionByName(paid.select("order_id", F.col("total_amount").alias("amount"), F.lit("card").alias("method"), F.lit("paid").alias("payment_status"), now.alias("payment_date")))
    carried = lookup(arriving, of_order, {"order_id": "order_id"}, ["store_id"])
    free = t["delivery_resource"].where("active_flag").select(F.col("id").alias("courier_id"), F.col("store_id").alias("at_store"))
    couriers = latest_by(free.withColumns({"slot": F.pmod(F.xxhash64("courier_id", F.lit(seed)), F.lit(16))}), ["at_store", "slot"], [uniform(seed, "courier_id")], ["courier_id"])
    carried = carried.withColumn("wanted", F.pmod(F.xxhash64("order_id"), F.lit(16)))
    brought = carried.join(F.broadcast(couriers), (F.col("store_id") == F.col("at_store")) & (F.col("wanted") == F.col("slot")), "left")  # sixteen couriers a store at most
    moves = F.array(F.struct(F.lit(1).alias("s"), F.lit("pick up").alias("n"), _at(day, 10, seed, "order_id").alias("at")), F.struct(F.lit(2).alias("s"), F.lit("delivery").alias("n"), _at(day, 12, seed, "order_id").alias("at")))
    told = brought.select("order_id", "courier_id", F.explode(moves).alias("m")).where("courier_id is not null")
    t["delivery_tracking"] = t["delivery_tracking"].unionByName(told.select("order_id", "courier_id", F.col("m.s").cast("smallint").alias("delivery_status_id"), F.col("m.n").alias("status"), F.col("m.at").alias("status_datetime")))
    return t
