"""Joins, aggregations, windows, sorting and unions (groups E to I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlane import scratch
from marketlane.functions.columns import not_cancelled
from marketlane.functions.money import money_avg, money_sum, money_sum_where, percent_where
from marketlane.operators import joins, quality, ranking
from marketlane.plans import dag_tables, gold, silver
from marketlane.registry.base import AS_OF, query
from marketlane.registry.changes import CUSTOMER_SQL, customer_loads, vsql
from marketlane.registry.products import bronze, dag_orders, job_orders, silver_orders, stored_silver
from marketlane.registry.reference_sql import mavg, msum, msum_if, pct_if, sql
from marketlane.sources import adapters, files

# ------------------------------------------------------------------- E


@query(
    "e1_left_lookup_joins",
    sql("""SELECT o.order_id, c.customer_segment, p.category FROM b_orders o
LEFT JOIN b_customers c ON o.customer_id = c.customer_id LEFT JOIN b_products p ON o.product_id = p.product_id"""),
)
def e1(spark, d):
    orders, customers, products = bronze(spark, d)
    joined = joins.lookup_join(orders, customers.select("customer_id", "customer_segment"), "customer_id", "order_id")
    joined = joins.lookup_join(joined, products.select("product_id", "category"), "product_id", "order_id")
    return joined.select("order_id", "customer_segment", "category")


HISTORY_SQL = """SELECT customer_id, order_id, order_date, min(order_date) OVER by_buyer AS first_order_date,
  count(order_id) OVER by_buyer AS lifetime_orders
FROM live WHERE customer_id IS NOT NULL WINDOW by_buyer AS (PARTITION BY customer_id)"""


def order_history(spark, d):
    """Each order with its buyer's first day and number of orders."""
    orders = adapters.orders(spark, d)
    history = scratch.durable(silver.customer_history(orders), "customer-history")
    live = silver.live_orders(orders).where(F.col("customer_id").isNotNull())
    rows = live.select("customer_id", "order_id", "order_date")
    hot = joins.hot_keys(history, "customer_id", "lifetime_orders")
    return joins.salted_join(rows, history, "customer_id", hot, "order_id")


@query(
    "e2_composite_key_join",
    sql(
        """SELECT o.order_id, o.customer_id, h.first_order_date, h.lifetime_orders FROM b_orders o
LEFT JOIN per_order h ON o.order_id = h.order_id AND o.customer_id = h.customer_id""",
        per_order=HISTORY_SQL,
    ),
)
def e2(spark, d):
    history = order_history(spark, d).drop("order_date")
    orders = adapters.orders(spark, d).select("order_id", "customer_id")
    return orders.join(history, ["order_id", "customer_id"], "left")


@query(
    "e3_left_join_with_conditions",
    sql("""SELECT c.customer_id, o.order_id, o.total_amount FROM b_customers c
LEFT JOIN b_orders o ON c.customer_id = o.customer_id AND upper(trim(o.status)) <> 'CANCELLED' AND o.total_amount > 2000"""),
)
def e3(spark, d):
    customers = adapters.customers(spark, d).select("customer_id")
    kept = adapters.orders(spark, d).where(not_cancelled(F.col("status")) & (F.col("total_amount") > 2000))
    kept = kept.select("customer_id", "order_id", "total_amount")
    return joins.matches_or_alone(customers, kept, "customer_id", "order_id")


@query(
    "e4_one_row_side",
    sql("""SELECT order_id, total_amount, biggest FROM b_orders
CROSS JOIN (SELECT coalesce(max(total_amount), 0) AS biggest FROM b_orders WHERE quantity > 0) one_row
WHERE total_amount > biggest / 2"""),
)
def e4(spark, d):
    orders = adapters.orders(spark, d)
    top = orders.where("quantity > 0").agg(F.coalesce(F.max("total_amount"), F.lit(0.0))).scalar()
    kept = orders.where(F.col("total_amount") > top / 2)
    return kept.select("order_id", "total_amount", top.alias("biggest"))


FAVOURITE_SQL = """SELECT customer_id, {c} AS v FROM valid GROUP BY customer_id, {c}
QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, {c} NULLS LAST) = 1"""


def favourite_tables(spark, d):
    valid = gold.valid_rows(stored_silver(spark, d, gold.CUSTOMER_READS))
    wanted = {
        "favorite_category": "product_category",
        "favorite_payment_method": "payment_method",
        "favorite_channel": "order_source",
    }
    return valid, {out: gold.favourites(valid, "customer_id", {out: column}) for out, column in wanted.items()}


@query(
    "e5_join_chain",
    sql(
        """SELECT s.customer_id, a.v AS favorite_category, p.v AS favorite_payment_method, h.v AS favorite_channel,
  c.registration_date
FROM (SELECT DISTINCT customer_id FROM valid) s LEFT JOIN top_category a ON s.customer_id = a.customer_id
LEFT JOIN top_payment p ON s.customer_id = p.customer_id LEFT JOIN top_source h ON s.customer_id = h.customer_id
LEFT JOIN b_customers c ON s.customer_id = c.customer_id""",
        top_category=FAVOURITE_SQL.format(c="product_category"),
        top_payment=FAVOURITE_SQL.format(c="payment_method"),
        top_source=FAVOURITE_SQL.format(c="order_source"),
    ),
)
def e5(spark, d):
    valid, tables = favourite_tables(spark, d)
    joined = valid.select("customer_id").distinct()
    for table in tables.values():
        joined = joined.join(table, "customer_id", "left")
    registered = adapters.customers(spark, d).select("customer_id", "registration_date")
    return joined.join(registered, "customer_id", "left")


@query(
    "e6_product_aggregates_and_stock",
    sql("""SELECT m.product_id, m.units_sold, m.total_revenue, p.stock_quantity AS current_stock
FROM moves m LEFT JOIN b_products p ON m.product_id = p.product_id"""),
)
def e6(spark, d):
    metrics = gold.product_metrics(stored_silver(spark, d, gold.PRODUCT_READS), AS_OF).select("product_id", "units_sold", "total_revenue")
    stock = adapters.products(spark, d).select("product_id", F.col("stock_quantity").alias("current_stock"))
    return metrics.join(stock, "product_id", "left")


@query(
    "e7_insert_absent",
    sql(
        """SELECT * FROM k_first UNION ALL
SELECT * FROM k_late late_row WHERE NOT EXISTS (FROM k_first f WHERE f.customer_id = late_row.customer_id)""",
        **CUSTOMER_SQL,
    ),
)
def e7(spark, d):
    first, late = customer_loads(spark, d)
    return joins.insert_absent(first, late, ["customer_id"])


# ------------------------------------------------------------------- F


@query(
    "f1_count_rows_and_values",
    sql("SELECT status, count(*) AS orders, count(product_id) AS with_product FROM b_orders GROUP BY status"),
)
def f1(spark, d):
    return adapters.orders(spark, d).groupBy("status").agg(
        F.count(F.lit(1)).alias("orders"), F.count("product_id").alias("with_product")
    )


@query(
    "f2_several_distinct_counts",
    sql("""SELECT payment_method, count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS customers,
  count(DISTINCT product_id) AS products FROM b_orders GROUP BY payment_method"""),
)
def f2(spark, d):
    return adapters.orders(spark, d).groupBy("payment_method").agg(
        F.countDistinct("order_id").alias("orders"),
        F.countDistinct("customer_id").alias("customers"),
        F.countDistinct("product_id").alias("products"),
    )


@query(
    "f3_sum_avg_min_max",
    sql(f"""SELECT customer_id, {msum('total_amount')} AS total, {mavg('total_amount')} AS mean,
  min(total_amount) AS smallest, max(order_date) AS latest FROM b_orders GROUP BY customer_id"""),
)
def f3(spark, d):
    return adapters.orders(spark, d).groupBy("customer_id").agg(
        money_sum("total_amount").alias("total"),
        money_avg("total_amount").alias("mean"),
        F.min("total_amount").alias("smallest"),
        F.max("order_date").alias("latest"),
    )


@query(
    "f3_sub_cent_sums",
    sql("""SELECT c_mktsegment AS segment, CAST(SUM(CAST(c_acctbal / 1000 AS DECIMAL(28,6))) AS DOUBLE) AS total,
  CAST(SUM(CAST(c_acctbal / 1000 AS DECIMAL(28,6))) AS DOUBLE) / count(c_acctbal) AS mean FROM customer GROUP BY c_mktsegment"""),
)
def f3_sub_cent(spark, d):
    customers = files.read_parquet(spark, f"{d}/customer.parquet")
    fee = F.col("c_acctbal") / 1000
    return customers.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        money_sum(fee).alias("total"), money_avg(fee).alias("mean")
    )


@query(
    "f4_conditional_sums",
    sql(f"""SELECT order_date, {msum_if("payment_method = 'PayPal'", 'total_amount')} AS paypal,
  {msum_if("payment_method = 'Credit Card'", 'total_amount')} AS credit_card FROM b_orders GROUP BY order_date"""),
)
def f4(spark, d):
    paid = F.col("payment_method")
    return adapters.orders(spark, d).groupBy("order_date").agg(
        money_sum_where(paid == "PayPal", "total_amount").alias("paypal"),
        money_sum_where(paid == "Credit Card", "total_amount").alias("credit_card"),
    )


@query(
    "f5_percent_in_group",
    sql(f"""SELECT order_date, {pct_if("status = 'pending'")} AS pending_pct FROM b_orders GROUP BY order_date"""),
)
def f5(spark, d):
    grouped = adapters.orders(spark, d).groupBy("order_date")
    return grouped.agg(percent_where(F.col("status") == "pending").alias("pending_pct"))


@query(
    "f6_global_aggregate",
    sql(f"SELECT count(*) AS orders, {msum('total_amount')} AS revenue, max(ingested_at) AS newest FROM b_orders"),
)
def f6(spark, d):
    return adapters.orders(spark, d).agg(
        F.count(F.lit(1)).alias("orders"),
        money_sum("total_amount").alias("revenue"),
        F.max("ingested_at").alias("newest"),
    )


@query(
    "f7_many_keys",
    sql(f"""SELECT customer_id, customer_name, customer_email, customer_segment, customer_city, customer_state,
  order_value_tier, payment_method, count(*) AS orders, {msum('total_amount')} AS revenue
FROM silver GROUP BY ALL"""),
)
def f7(spark, d):
    keys = [
        "customer_id", "customer_name", "customer_email", "customer_segment", "customer_city", "customer_state",
        "order_value_tier", "payment_method",
    ]
    return silver_orders(spark, d).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("orders"), money_sum("total_amount").alias("revenue")
    )


@query(
    "f8_first_and_last",
    sql("SELECT product_id, min(order_date) AS first_sale, max(order_date) AS last_sale FROM b_orders GROUP BY product_id"),
)
def f8(spark, d):
    return adapters.orders(spark, d).groupBy("product_id").agg(
        F.min("order_date").alias("first_sale"), F.max("order_date").alias("last_sale")
    )


@query(
    "f9_all_true",
    sql("""SELECT coalesce(bool_and(order_id IS NOT NULL), TRUE) AS ids, coalesce(bool_and(coalesce(total_amount > 0, FALSE)), TRUE)
  AS amounts, coalesce(bool_and(coalesce(quantity >= 0, FALSE)), TRUE) AS quantities FROM b_orders"""),
)
def f9(spark, d):
    def every(condition):
        return F.coalesce(F.bool_and(F.coalesce(condition, F.lit(False))), F.lit(True))

    return adapters.orders(spark, d).agg(
        every(F.col("order_id").isNotNull()).alias("ids"),
        every(F.col("total_amount") > 0).alias("amounts"),
        every(F.col("quantity") >= 0).alias("quantities"),
    )


@query(
    "f10_distinct_values",
    sql("""SELECT DISTINCT 'status' AS column_name, status AS value FROM b_orders
UNION ALL SELECT DISTINCT 'payment_method', payment_method FROM b_orders
UNION ALL SELECT DISTINCT 'order_source', order_source FROM b_orders
UNION ALL SELECT DISTINCT 'customer_segment', customer_segment FROM b_customers
UNION ALL SELECT DISTINCT 'category', category FROM b_products"""),
)
def f10(spark, d):
    orders, customers, products = bronze(spark, d)

    def values(df, *names):
        pairs = F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("value")) for n in names])
        return df.select(F.explode(pairs).alias("p")).select("p.*").distinct()

    return (
        values(orders, "status", "payment_method", "order_source")
        .unionByName(values(customers, "customer_segment"))
        .unionByName(values(products, "category"))
    )


# ------------------------------------------------------------------- G


@query("g1_customer_windows", sql(HISTORY_SQL))
def g1(spark, d):
    return order_history(spark, d).select(
        "customer_id", "order_id", "order_date", "first_order_date", "lifetime_orders"
    )


@query(
    "g2_favourites",
    sql(
        """SELECT a.customer_id, a.v AS favorite_category, p.v AS favorite_payment_method, h.v AS favorite_channel
FROM top_category a JOIN top_payment p ON a.customer_id = p.customer_id JOIN top_source h ON a.customer_id = h.customer_id""",
        top_category=FAVOURITE_SQL.format(c="product_category"),
        top_payment=FAVOURITE_SQL.format(c="payment_method"),
        top_source=FAVOURITE_SQL.format(c="order_source"),
    ),
)
def g2(spark, d):
    return gold.favourites(
        gold.valid_rows(silver_orders(spark, d)),
        "customer_id",
        {
            "favorite_category": "product_category",
            "favorite_payment_method": "payment_method",
            "favorite_channel": "order_source",
        },
    )


def customer_totals(spark, d):
    totals = gold.customer_metrics(silver_orders(spark, d), AS_OF)
    return scratch.durable(totals, "customer-totals")


@query(
    "g3_global_ntile",
    sql("""SELECT customer_id, CAST(ntile(5) OVER (ORDER BY days_since_last_order, customer_id) AS INT) AS recency_score,
  CAST(ntile(5) OVER (ORDER BY total_orders DESC, customer_id) AS INT) AS frequency_score,
  CAST(ntile(5) OVER (ORDER BY lifetime_value DESC, customer_id) AS INT) AS monetary_score FROM spend"""),
)
def g3(spark, d):
    scored = ranking.score_scales(
        customer_totals(spark, d),
        ["customer_id"],
        scales={
            "recency": (None, "days_since_last_order", False),
            "frequency": (None, "total_orders", True),
            "value": (None, "lifetime_value", True),
        },
        tiles={
            "recency_score": ("recency", 5),
            "frequency_score": ("frequency", 5),
            "monetary_score": ("value", 5),
        },
    )
    return scored.select("customer_id", "recency_score", "frequency_score", "monetary_score")


@query(
    "g4_global_rank",
    sql("""SELECT customer_id, total_orders, rank() OVER (ORDER BY total_orders DESC) AS orders_rank,
  row_number() OVER (ORDER BY total_orders DESC, customer_id) AS place FROM spend"""),
)
def g4(spark, d):
    totals = customer_totals(spark, d).select("customer_id", "total_orders")
    placed = ranking.positions(totals, ["customer_id"], [("total_orders", True)])
    return placed.select(
        "customer_id", "total_orders", F.col("rank").alias("orders_rank"), F.col("row_number").alias("place")
    )


@query(
    "g5_rank_in_group",
    sql("""SELECT customer_id, customer_segment, rank() OVER (PARTITION BY customer_segment ORDER BY total_orders DESC)
  AS segment_rank FROM spend"""),
)
def g5(spark, d):
    totals = customer_totals(spark, d).select("customer_id", "customer_segment", "total_orders")
    scales = {"segment": ("customer_segment", "total_orders", True)}
    ranked = ranking.score_scales(totals, ["customer_id"], scales, ranks={"segment_rank": "segment"})
    return ranked.select("customer_id", "customer_segment", "segment_rank")


@query(
    "g6_against_overall_mean",
    sql("""SELECT customer_id, lifetime_value,
  CAST(sum(CAST(lifetime_value AS DECIMAL(28,6))) OVER () AS DOUBLE) / count(lifetime_value) OVER () AS mean
FROM spend"""),
)
def g6(spark, d):
    totals = gold.customer_metrics(silver_orders(spark, d), AS_OF).select("customer_id", "lifetime_value")
    mean = totals.agg(money_avg("lifetime_value")).scalar()
    return totals.select("customer_id", "lifetime_value", mean.alias("mean"))


@query(
    "g7_share_of_total",
    sql("""SELECT payment_method, count(*) AS orders, CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER () AS pct
FROM b_orders GROUP BY payment_method"""),
)
def g7(spark, d):
    counted = adapters.orders(spark, d).groupBy("payment_method").agg(F.count(F.lit(1)).alias("orders"))
    return counted.withColumn("pct", joins.share_of_total(counted, "orders"))


# --------------------------------------------------------------- H and I


@query("h1_order_by", sql("SELECT order_id, customer_id, order_date FROM b_orders"))
def h1(spark, d):
    rows = adapters.orders(spark, d).select("order_id", "customer_id", "order_date")
    return rows.orderBy(F.col("order_date").desc_nulls_last(), F.col("customer_id").asc_nulls_last(), "order_id")


@query("h2_limit", "SELECT least(count(*), 10) AS taken, least(count(*), 10) AS in_source FROM orders")
def h2(spark, d):
    """Any ten rows: how many they are, and how many of them the source has."""
    source = adapters.orders(spark, d)
    taken = scratch.durable(source.limit(10), "limit")
    found = taken.join(source, "order_id", "left_semi").agg(F.count(F.lit(1)).alias("in_source"))
    return taken.agg(F.count(F.lit(1)).alias("taken")).select("taken", found.scalar().alias("in_source"))


@query(
    "h3_top_k",
    sql("SELECT order_id, total_amount FROM b_orders ORDER BY total_amount DESC NULLS LAST, order_id LIMIT 20"),
)
def h3(spark, d):
    rows = adapters.orders(spark, d).select("order_id", "total_amount")
    return rows.orderBy(F.col("total_amount").desc_nulls_last(), "order_id").limit(20)


@query(
    "h4_top_region",
    sql("SELECT state AS top_revenue_state FROM dag_regions ORDER BY total_revenue DESC, state LIMIT 1"),
)
def h4(spark, d):
    return dag_tables.top_region(dag_tables.regional_sales(dag_orders(spark, d)))


@query(
    "i1_union_all",
    sql("""SELECT 'bronze.orders' AS layer, count(*) AS row_count FROM b_orders UNION ALL
SELECT 'bronze.customers', count(*) FROM b_customers UNION ALL SELECT 'bronze.products', count(*) FROM b_products"""),
)
def i1(spark, d):
    orders, customers, products = bronze(spark, d)
    return quality.layer_counts(
        {"bronze.orders": orders, "bronze.customers": customers, "bronze.products": products}
    )
