from datetime import date

from pyspark.sql import functions as F

from lamina.sources import generator as g


def test_shop(spark):
    first = g.first_tables(spark, date(2024, 1, 1), clients=60, couriers=40)
    assert {n: df.count() for n, df in first.items() if n in ("zones", "delivery_costing", "assortment", "costing", "products", "orders")} == {"zones": 24, "delivery_costing": 72, "assortment": 360, "costing": 360, "products": 72, "orders": 0}
    tables = first
    for n in range(4):
        tables = {k: spark.createDataFrame(df.collect(), df.schema) for k, df in g.next_day(tables, date(2024, 1, 2 + n), 10 + n, new_clients=2, repriced=0.2).items()}
    lines = tables["order_product"].groupBy("order_id").agg(F.count("*").alias("n"), F.count_distinct("product_id").alias("d"), F.sum(F.round(F.col("quantity") * F.col("sales_price"), 2)).alias("v"))
    orders = tables["orders"].join(lines, F.col("id") == F.col("order_id")).collect()
    assert len(orders) == tables["orders"].count() > 10 and all(5 <= r.n <= 20 and r.n == r.d and r.v == r.total_amount for r in orders)
    assert tables["clients"].count() == 68 and tables["clients"].select("id").distinct().count() == 68
    versions = tables["products"].groupBy("id").agg(F.count_if(F.col("valid_to").isNull()).alias("open"), F.count("*").alias("n")).collect()
    assert all(r.open == 1 for r in versions) and any(r.n > 1 for r in versions)
    status = {r.order_id: r.s for r in tables["order_status_history"].groupBy("order_id").agg(F.max("order_status_id").alias("s")).collect()}
    paid = [r.order_id for r in tables["payments"].collect()]
    assert sorted(paid) == sorted(o for o, s in status.items() if s == g.DELIVERED) and len(paid) == len({*paid})
    homes = tables["delivery_tracking"].join(tables["orders"].select(F.col("id").alias("order_id"), "store_id"), "order_id").join(tables["delivery_resource"].select(F.col("id").alias("courier_id"), F.col("store_id").alias("home")), "courier_id")
    assert homes.where("store_id <> home").count() == 0
    again = g.next_day(first, date(2024, 1, 2), 10, new_clients=2, repriced=0.2)["orders"]
    assert sorted(map(tuple, again.repartition(3).collect())) == sorted(map(tuple, g.next_day(first, date(2024, 1, 2), 10, new_clients=2, repriced=0.2)["orders"].collect()))


def test_draws(spark):
    df = spark.range(4000).select(g.uniform(1, "id").alias("u"), g.beta(1, 2, 4, "id").alias("b"))
    u, b = df.agg(F.avg("u"), F.avg("b")).first()
    assert abs(u - 0.5) < 0.03 and abs(b - 2 / 6) < 0.03
