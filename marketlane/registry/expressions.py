"""Projections, scalar functions and predicates (groups C and D)."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlane import scratch
from marketlane.functions import columns as C
from marketlane.operators import upsert
from marketlane.plans import rollup
from marketlane.registry.base import AS_OF, CUT, MONTH_DAY, NOW, query
from marketlane.registry.products import job_orders, silver_orders
from marketlane.registry.reference_sql import sql
from marketlane.registry.states import states
from marketlane.registry.changes import vsql
from marketlane.sources import adapters, files


@query("c1_select_rename", sql("SELECT order_id AS id, total_amount AS amount, status FROM b_orders"))
def c1(spark, d):
    return adapters.orders(spark, d).select(
        F.col("order_id").alias("id"), F.col("total_amount").alias("amount"), "status"
    )


@query(
    "c2_literals",
    sql("SELECT order_id, CAST(1 AS BIGINT) AS customer_lifetime_orders, 'New' AS customer_value_tier, "
        "FALSE AS is_first_order, FALSE AS is_repeat_customer FROM b_orders"),
)
def c2(spark, d):
    return adapters.orders(spark, d).select(
        "order_id",
        F.lit(1).cast("bigint").alias("customer_lifetime_orders"),
        F.lit("New").alias("customer_value_tier"),
        F.lit(False).alias("is_first_order"),
        F.lit(False).alias("is_repeat_customer"),
    )


@query(
    "c3_ingest_stamps",
    sql("""SELECT product_id, product_name, category, price, stock_quantity, TIMESTAMP '2001-08-02 00:00:00' AS ingested_at,
  TRUE AS has_source_file, 'pending' AS data_quality_flag FROM b_products"""),
)
def c3(spark, d):
    path = scratch.new_dir(spark, "products-csv")
    files.write_csv(adapters.products(spark, d).drop("ingested_at"), path)
    schema = "product_id STRING, product_name STRING, category STRING, price DOUBLE, stock_quantity INT"
    rows = files.stamped(files.read_csv(spark, path, schema), NOW)
    return rows.withColumn("has_source_file", F.col("source_file").endswith(".csv")).drop("source_file")


@query(
    "c4_text_to_date",
    sql("""SELECT order_id, CAST(CAST(order_date AS VARCHAR) AS DATE) AS order_date,
  try_cast(order_source AS DATE) AS not_a_date FROM b_orders"""),
)
def c4(spark, d):
    return adapters.orders(spark, d).select(
        "order_id",
        F.to_date(F.col("order_date").cast("string")).alias("order_date"),
        F.try_to_date("order_source").alias("not_a_date"),
    )


@query(
    "c5_year_month_quarter",
    sql("""SELECT order_id, CAST(extract(year FROM order_date) AS INT) AS order_year,
  CAST(extract(month FROM order_date) AS INT) AS order_month,
  CAST(extract(quarter FROM order_date) AS INT) AS order_quarter FROM b_orders"""),
)
def c5(spark, d):
    parts = C.calendar(F.col("order_date"))
    names = ("order_year", "order_month", "order_quarter")
    return adapters.orders(spark, d).select("order_id", *[parts[n].alias(n) for n in names])


@query(
    "c6_weekday",
    sql("""SELECT order_id, CAST(extract(dow FROM order_date) + 1 AS INT) AS day_of_week,
  extract(dow FROM order_date) IN (0, 6) AS is_weekend FROM b_orders"""),
)
def c6(spark, d):
    parts = C.calendar(F.col("order_date"))
    names = ("day_of_week", "is_weekend")
    return adapters.orders(spark, d).select("order_id", *[parts[n].alias(n) for n in names])


@query(
    "c7_days_between",
    sql("""SELECT customer_id, CAST(date_diff('day', min(order_date), max(order_date)) AS INT) AS days_active
FROM b_orders GROUP BY customer_id"""),
)
def c7(spark, d):
    grouped = adapters.orders(spark, d).groupBy("customer_id")
    return grouped.agg(F.datediff(F.max("order_date"), F.min("order_date")).alias("days_active"))


@query(
    "c8_days_before",
    sql("""SELECT order_id, order_date >= DATE '2001-08-02' - 30 AS in_last_30,
  order_date BETWEEN DATE '2001-08-02' - 60 AND DATE '2001-08-02' - 31 AS in_previous_30 FROM b_orders"""),
)
def c8(spark, d):
    today, day = C.date_lit(AS_OF), F.col("order_date")
    return adapters.orders(spark, d).select(
        "order_id",
        (day >= F.date_sub(today, 30)).alias("in_last_30"),
        day.between(F.date_sub(today, 60), F.date_sub(today, 31)).alias("in_previous_30"),
    )


@query(
    "c9_current_moment",
    sql("""SELECT order_id, DATE '2001-08-02' AS today, TIMESTAMP '2001-08-02 00:00:00' AS processed_at,
  CAST(date_diff('day', order_date, DATE '2001-08-02') AS INT) AS age_days FROM b_orders"""),
)
def c9(spark, d):
    return adapters.orders(spark, d).select(
        "order_id",
        C.date_lit(AS_OF).alias("today"),
        C.ts_lit(NOW).alias("processed_at"),
        F.datediff(C.date_lit(AS_OF), "order_date").alias("age_days"),
    )


@query(
    "c10_trim_and_case",
    sql("""SELECT order_id, upper(trim(status)) AS status, trim(payment_method) AS payment_method,
  lower(trim(order_source)) AS order_source FROM b_orders"""),
)
def c10(spark, d):
    return adapters.orders(spark, d).select(
        "order_id",
        C.status_code(F.col("status")).alias("status"),
        F.trim("payment_method").alias("payment_method"),
        F.lower(F.trim("order_source")).alias("order_source"),
    )


@query(
    "c11_concatenation",
    sql("""SELECT customer_id, trim(first_name) || ' ' || trim(last_name) AS customer_name,
  email || '/' || state AS email_and_state FROM b_customers"""),
)
def c11(spark, d):
    return adapters.customers(spark, d).select(
        "customer_id",
        C.full_name(F.col("first_name"), F.col("last_name")).alias("customer_name"),
        F.concat("email", F.lit("/"), "state").alias("email_and_state"),
    )


@query(
    "c12_tiers",
    sql("""SELECT order_id, CASE WHEN total_amount > 1000 THEN 'High Value' WHEN total_amount > 500 THEN 'Medium Value'
  WHEN total_amount > 100 THEN 'Low Value' ELSE 'Minimal Value' END AS order_value_tier,
  CASE WHEN lower(trim(order_source)) IN ('web', 'mobile', 'app') THEN 'Online'
  WHEN lower(trim(order_source)) IN ('store', 'pos') THEN 'In-Store' ELSE 'Partner' END AS channel_category,
  CAST(CASE WHEN total_amount < 50 THEN 10 WHEN total_amount < 100 THEN 5 ELSE 0 END AS DOUBLE) AS shipping_cost
FROM b_orders"""),
)
def c12(spark, d):
    return adapters.orders(spark, d).select(
        "order_id",
        C.order_tier(F.col("total_amount")).alias("order_value_tier"),
        C.channel(F.col("order_source")).alias("channel_category"),
        C.shipping(F.col("total_amount")).alias("shipping_cost"),
    )


@query(
    "c13_coalesce",
    sql("SELECT order_id, coalesce(order_source, 'unknown') AS order_source, coalesce(product_id, customer_id, 'none') AS subject FROM b_orders"),
)
def c13(spark, d):
    return adapters.orders(spark, d).select(
        "order_id",
        F.coalesce("order_source", F.lit("unknown")).alias("order_source"),
        F.coalesce("product_id", "customer_id", F.lit("none")).alias("subject"),
    )


@query(
    "c14_greatest",
    sql("""SELECT order_id, greatest(quantity * unit_price - total_amount, CAST(0 AS DOUBLE)) AS discount_amount
FROM job_orders"""),
)
def c14(spark, d):
    subtotal = F.col("quantity") * F.col("unit_price")
    return job_orders(spark, d).select(
        "order_id", C.discount(subtotal, F.col("total_amount")).alias("discount_amount")
    )


@query(
    "c15_arithmetic",
    sql("""SELECT order_id, quantity * unit_price AS subtotal, total_amount * CAST(0.08 AS DOUBLE) AS tax_amount,
  CASE WHEN total_amount > 0 THEN (total_amount - quantity * unit_price * CAST(0.6 AS DOUBLE)) / total_amount * 100 END
    AS profit_margin_pct FROM job_orders"""),
)
def c15(spark, d):
    quantity, price, total = F.col("quantity"), F.col("unit_price"), F.col("total_amount")
    return job_orders(spark, d).select(
        "order_id",
        (quantity * price).alias("subtotal"),
        (total * F.lit(C.TAX_RATE)).alias("tax_amount"),
        C.margin_pct(total, quantity, price).alias("profit_margin_pct"),
    )


@query(
    "c16_cast_and_round",
    sql("""SELECT order_id, CAST(trunc(total_amount) AS INT) AS whole, CAST(quantity AS DOUBLE) AS quantity_double,
  CAST(quantity AS VARCHAR) AS quantity_text,
  CAST(round(CAST(total_amount AS DECIMAL(18,2)), 1) AS DOUBLE) AS rounded FROM b_orders"""),
)
def c16(spark, d):
    return adapters.orders(spark, d).select(
        "order_id",
        F.col("total_amount").cast("int").alias("whole"),
        F.col("quantity").cast("double").alias("quantity_double"),
        F.col("quantity").cast("string").alias("quantity_text"),
        F.round(F.col("total_amount").cast("decimal(18,2)"), 1).cast("double").alias("rounded"),
    )


@query(
    "c17_epoch_default",
    vsql("""SELECT order_id, coalesce(CASE WHEN order_date >= DATE '2001-01-01' THEN ingested_at END,
  TIMESTAMP '1970-01-01 00:00:00') AS seen_at FROM b_orders"""),
)
def c17(spark, d):
    recent = F.when(F.col("order_date") >= C.date_lit(CUT.date()), F.col("ingested_at"))
    return adapters.orders(spark, d).select(
        "order_id", F.coalesce(recent, C.ts_lit(upsert.EPOCH)).alias("seen_at")
    )


@query(
    "c18_boolean_column",
    sql("SELECT order_id, coalesce(total_amount > 500, FALSE) AS is_high_value FROM b_orders"),
)
def c18(spark, d):
    return adapters.orders(spark, d).select(
        "order_id", F.coalesce(F.col("total_amount") > 500, F.lit(False)).alias("is_high_value")
    )


@query(
    "c19_cost_cap",
    sql("SELECT product_id, price, least(CAST(stock_quantity AS DOUBLE), price * CAST(0.7 AS DOUBLE)) AS cost FROM b_products"),
)
def c19(spark, d):
    products = adapters.products(spark, d).select(
        "product_id", "price", F.col("stock_quantity").cast("double").alias("cost")
    )
    return rollup.capped_cost(products)


# ------------------------------------------------------------------- D


@query("d1_status_filter", sql("SELECT order_id, status FROM b_orders WHERE status <> 'cancelled'"))
def d1(spark, d):
    return adapters.orders(spark, d).where(F.col("status") != "cancelled").select("order_id", "status")


@query("d2_numeric_filter", sql("SELECT order_id, total_amount FROM b_orders WHERE total_amount > 0 AND quantity >= 3"))
def d2(spark, d):
    orders = adapters.orders(spark, d)
    return orders.where("total_amount > 0 AND quantity >= 3").select("order_id", "total_amount")


@query(
    "d3_null_filter",
    sql("SELECT order_id, customer_id, product_id FROM b_orders WHERE customer_id IS NOT NULL AND product_id IS NULL"),
)
def d3(spark, d):
    orders = adapters.orders(spark, d)
    kept = orders.where(F.col("customer_id").isNotNull() & F.col("product_id").isNull())
    return kept.select("order_id", "customer_id", "product_id")


@query(
    "d4_in_list",
    sql("""SELECT order_id, payment_method, order_source FROM b_orders
WHERE payment_method NOT IN ('Credit Card', 'PayPal') AND lower(trim(order_source)) IN ('web', 'mobile', 'app')"""),
)
def d4(spark, d):
    orders = adapters.orders(spark, d)
    kept = orders.where(
        ~F.col("payment_method").isin("Credit Card", "PayPal")
        & F.lower(F.trim("order_source")).isin(*C.ONLINE_SOURCES)
    )
    return kept.select("order_id", "payment_method", "order_source")


@query(
    "d5_between_dates",
    sql("SELECT order_id, order_date FROM b_orders WHERE order_date BETWEEN DATE '2001-06-03' AND DATE '2001-07-02'"),
)
def d5(spark, d):
    today = C.date_lit(AS_OF)
    between = F.col("order_date").between(F.date_sub(today, 60), F.date_sub(today, 31))
    return adapters.orders(spark, d).where(between).select("order_id", "order_date")


@query("d6_boolean_filter", sql("SELECT order_id, is_first_order FROM silver WHERE is_first_order"))
def d6(spark, d):
    return silver_orders(spark, d).where(F.col("is_first_order")).select("order_id", "is_first_order")


@query(
    "d7_scalar_subquery_filter",
    vsql("""SELECT order_id, ingested_at FROM b_orders
WHERE ingested_at > (SELECT coalesce(max(ingested_at), TIMESTAMP '1970-01-01 00:00:00') FROM v_base)"""),
)
def d7(spark, d):
    mark = upsert.high_water_mark(states(spark, d).base, "ingested_at")
    return adapters.orders(spark, d).where(F.col("ingested_at") > mark).select("order_id", "ingested_at")


@query(
    "d8_month_partition_filter",
    sql("SELECT order_id, order_year, order_month, total_amount FROM job_orders WHERE order_year = 2001 AND order_month = 7"),
)
def d8(spark, d):
    path = scratch.new_dir(spark, "by-month")
    files.write_parquet(job_orders(spark, d), path, ("order_year", "order_month"))
    today = C.date_lit(MONTH_DAY)
    month = (F.col("order_year") == F.year(today)) & (F.col("order_month") == F.month(today))
    stored = files.read_parquet(spark, path)
    return stored.where(month).select("order_id", "order_year", "order_month", "total_amount")
