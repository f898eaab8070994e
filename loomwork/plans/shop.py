"""Star-schema questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwork.operators import shop
from loomwork.plans.registry import register
from loomwork.sources.derived import table


def star(spark, folder):
    """The shop star over the base tables."""
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    return {
        "customers": table(spark, folder, "customer").join(nations, "c_nationkey", "left").select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "country"
        ),
        "products": table(spark, folder, "part").select(
            F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("category"),
            F.col("p_retailprice").alias("price"),
        ),
        "orders": table(spark, folder, "orders").select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer_id"),
            F.to_date("o_orderdate").alias("order_date"), F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").alias("total_amount"),
        ),
        "order_items": table(spark, folder, "lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"),
            F.col("l_partkey").alias("product_id"), F.col("l_quantity").alias("quantity"),
            F.to_date("l_shipdate").alias("ship_date"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        ),
    }


@register("top_customers", """
SELECT o_custkey AS customer_id, round(sum(o_totalprice), 2) + 0.0 AS total_spend, min(c_name) AS name
FROM orders LEFT JOIN customer ON c_custkey = o_custkey GROUP BY 1
ORDER BY sum(o_totalprice) DESC, 1 LIMIT 3""", digits=2)
def _(spark, folder):
    t = star(spark, folder)
    return shop.top_customers(t["customers"], t["orders"])


@register("best_category", """
SELECT p_type AS category, round(sum(l_quantity), 6) + 0.0 AS units
FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def _(spark, folder):
    t = star(spark, folder)
    return shop.best_category(t["products"], t["order_items"])


@register("repeat_customers", """
SELECT o_custkey AS customer_id, count(*) AS n_orders FROM orders GROUP BY 1 HAVING count(*) > 1""")
def _(spark, folder):
    return shop.repeat_customers(star(spark, folder)["orders"])


@register("avg_order_by_country", """
SELECT n_name AS country, round(CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / CAST(count(*) AS DOUBLE) / 100, 6) + 0.0 AS avg_order_value
FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey GROUP BY 1""")
def _(spark, folder):
    """Amounts are summed as whole cents and divided once, so the mean does not hang on the order of addition."""
    t = star(spark, folder)
    cents = t["orders"].withColumn("total_amount", F.round(F.col("total_amount") * 100).cast("bigint"))
    means = shop.avg_order_by_country(t["customers"], cents)
    return means.withColumn("avg_order_value", F.col("avg_order_value") / 100)


@register("order_status_counts", "SELECT o_orderstatus AS status, count(*) AS n_orders FROM orders GROUP BY 1")
def _(spark, folder):
    return shop.order_status_counts(star(spark, folder)["orders"])


@register("never_ordered", """
SELECT p_partkey AS id, p_name AS name, p_type AS category, round(p_retailprice, 6) + 0.0 AS price FROM part
WHERE NOT EXISTS (SELECT 1 FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
                  JOIN nation ON n_nationkey = c_nationkey WHERE l_partkey = p_partkey AND n_name = 'FRANCE')""")
def _(spark, folder):
    """Products that no customer in France ever ordered."""
    t = star(spark, folder)
    buyers = t["customers"].filter("country = 'FRANCE'").select(F.col("id").alias("customer_id"))
    orders = t["orders"].join(buyers, "customer_id", "left_semi").select(F.col("id").alias("order_id"))
    return shop.never_ordered(t["products"], t["order_items"].join(orders, "order_id", "left_semi"))


@register("bounded_sql", """
SELECT o_custkey AS customer_id, count(*) AS n_orders, round(sum(o_totalprice), 2) + 0.0 AS spend
FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 50""", digits=2)
def _(spark, folder):
    shop.register_star(star(spark, folder))
    rows, error = shop.bounded_sql(spark, """
        SELECT customer_id, count(*) AS n_orders, sum(total_amount) AS spend
        FROM orders GROUP BY customer_id ORDER BY n_orders DESC, customer_id;""")
    if error:
        raise ValueError(error)
    return rows


@register("result_preview", """
SELECT o_orderkey AS id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS status,
       round(o_totalprice, 2) + 0.0 AS total_amount FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""", digits=2)
def _(spark, folder):
    return shop.result_preview(star(spark, folder)["orders"], [F.desc("total_amount"), "id"])


@register("schema_card")
def _(spark, folder):
    keys = {"customers": ["id"], "products": ["id"], "orders": ["id"], "order_items": ["order_id", "line"]}
    return shop.schema_card(star(spark, folder), keys)


@register("star_tables", """
SELECT 'customers' AS table_name, count(*) AS n_rows FROM customer UNION ALL
SELECT 'products', count(*) FROM part UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL
SELECT 'order_items', count(*) FROM lineitem""")
def _(spark, folder):
    names = shop.register_star(star(spark, folder))
    return spark.sql(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in names))
