"""Quality checks, figures, ingestion, roll-up and catalogue data (groups N, P and the rest of O)."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlane import scratch
from marketlane.operators import quality
from marketlane.plans import catalogue, dag_tables, daily_run, gold, kpi, rollup
from marketlane.registry.base import AS_OF, MONTH_DAY, NOW, query
from marketlane.registry.changes import vsql
from marketlane.registry.products import bronze, dag_orders, silver_orders, stored_silver
from marketlane.registry.reference_sql import msum, sql
from marketlane.registry.states import states
from marketlane.sources import adapters, files


@query(
    "n1_table_checks",
    sql("""
SELECT 'orders' AS table_name, check_name, bad = 0 AS passed, bad AS failed_rows
FROM (SELECT count(*) FILTER (WHERE order_id IS NULL) AS a, count(*) FILTER (WHERE customer_id IS NULL) AS b,
    count(*) FILTER (WHERE NOT coalesce(total_amount > 0, FALSE)) AS c,
    count(*) FILTER (WHERE NOT coalesce(quantity > 0, FALSE)) AS e,
    count(*) FILTER (WHERE NOT coalesce(status IN ('completed', 'pending', 'cancelled'), FALSE)) AS f FROM b_orders) k,
  LATERAL (VALUES ('no_null_order_id', a), ('no_null_customer_id', b), ('positive_amounts', c), ('valid_quantities', e),
    ('valid_status', f), ('all_passed', a + b + c + e + f)) checks(check_name, bad)"""),
)
def n1(spark, d):
    return quality.check_rows(adapters.orders(spark, d), "orders", quality.order_checks())


@query(
    "n2_row_flags",
    sql("""
SELECT o.order_id, CASE WHEN o.total_amount <= 0 THEN 'INVALID_AMOUNT' WHEN o.quantity <= 0 THEN 'INVALID_QUANTITY'
  WHEN p.product_id IS NULL THEN 'MISSING_PRODUCT' WHEN c.customer_id IS NULL THEN 'MISSING_CUSTOMER' ELSE 'VALID' END
  AS data_quality_flag
FROM b_orders o LEFT JOIN b_customers c ON o.customer_id = c.customer_id
LEFT JOIN b_products p ON o.product_id = p.product_id"""),
)
def n2(spark, d):
    from marketlane.functions.columns import quality_flag
    from marketlane.operators.joins import lookup_join

    orders, customers, products = bronze(spark, d)
    known = customers.select("customer_id", F.lit(True).alias("_buyer"))
    sold = products.select("product_id", F.lit(True).alias("_goods"))
    joined = lookup_join(lookup_join(orders, known, "customer_id", "order_id"), sold, "product_id", "order_id")
    flag = quality_flag(
        F.col("total_amount"), F.col("quantity"), F.col("_goods").isNotNull(), F.col("_buyer").isNotNull()
    )
    return joined.select("order_id", flag.alias("data_quality_flag"))


@query(
    "n3_flag_distribution",
    sql("""SELECT data_quality_flag, count(*) AS records,
  CAST(floor(CAST(count(*) AS DOUBLE) * 10000 / sum(count(*)) OVER () + 0.5) AS DOUBLE) / 100 AS pct
FROM silver GROUP BY data_quality_flag"""),
)
def n3(spark, d):
    return quality.flag_distribution(silver_orders(spark, d))


@query(
    "n4_freshness",
    sql("""SELECT 'bronze.orders' AS table_name, count(*) AS row_count, max(ingested_at) AS last_ingested FROM b_orders
UNION ALL SELECT 'bronze.customers', count(*), max(ingested_at) FROM b_customers
UNION ALL SELECT 'bronze.products', count(*), max(ingested_at) FROM b_products"""),
)
def n4(spark, d):
    orders, customers, products = bronze(spark, d)
    return quality.freshness({"bronze.orders": orders, "bronze.customers": customers, "bronze.products": products})


@query(
    "n5_layer_counts",
    sql("""SELECT 'bronze.orders' AS layer, count(*) AS row_count FROM b_orders
UNION ALL SELECT 'bronze.customers', count(*) FROM b_customers
UNION ALL SELECT 'bronze.products', count(*) FROM b_products
UNION ALL SELECT 'silver.orders_enriched', count(*) FROM silver
UNION ALL SELECT 'silver.customer_profiles', count(*) FROM profiles
UNION ALL SELECT 'gold.daily_sales_summary', count(*) FROM daily
UNION ALL SELECT 'gold.customer_360', count(*) FROM spend
UNION ALL SELECT 'gold.product_performance', count(*) FROM moves"""),
)
def n5(spark, d):
    """Counts over a complete run, written layer by layer."""
    orders, customers, products = bronze(spark, d)
    out = scratch.new_dir(spark, "daily-run")
    made = daily_run.run(spark, orders, customers, products, out, AS_OF, NOW, {"bronze.orders": ()})
    return made["layers"]


@query(
    "n6_key_uniqueness",
    sql("""SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber
HAVING count(*) > 1"""),
)
def n6(spark, d):
    return quality.duplicate_keys(adapters.raw(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "o8_kpi_quick_view",
    sql(f"""SELECT 'Revenue MTD' AS metric, CAST(CAST({msum('total_amount')} AS DECIMAL(20,2)) AS VARCHAR) AS value
FROM valid WHERE order_year = 2001 AND order_month = 7
UNION ALL SELECT 'Clients à risque churn (>0.5)', CAST(count(*) AS VARCHAR) FROM c360 WHERE churn_risk_score > 0.5
UNION ALL SELECT 'Produits à réapprovisionner', CAST(count(*) AS VARCHAR) FROM pperf WHERE reorder_recommended"""),
)
def o8(spark, d):
    silver_table = stored_silver(spark, d)
    customers = gold.customer_360(silver_table, adapters.customers(spark, d), AS_OF, NOW)
    products = gold.product_performance(silver_table, adapters.products(spark, d), AS_OF, NOW)
    return kpi.quick_view(silver_table, customers, products, MONTH_DAY)


_RAW = {  # table: adapter, CSV columns, date columns
    "customers": (
        adapters.customers,
        "customer_id STRING, email STRING, first_name STRING, last_name STRING, city STRING, state STRING, "
        "registration_date STRING, customer_segment STRING",
        ("registration_date",),
    ),
    "products": (
        adapters.products,
        "product_id STRING, product_name STRING, category STRING, price DOUBLE, stock_quantity INT",
        (),
    ),
    "orders": (
        adapters.orders,
        "order_id STRING, customer_id STRING, order_date STRING, product_id STRING, quantity INT, status STRING, "
        "payment_method STRING, total_amount DOUBLE, order_source STRING",
        ("order_date",),
    ),
}


@query(
    "o21_bronze_ingest",
    sql("""SELECT 'customers' AS source_table, customer_id AS record_key, registration_date AS record_date, email AS label,
  CAST(NULL AS DOUBLE) AS amount, TIMESTAMP '2001-08-02 00:00:00' AS ingested_at, 'pending' AS data_quality_flag FROM b_customers
UNION ALL SELECT 'products', product_id, NULL, product_name, price, TIMESTAMP '2001-08-02 00:00:00', 'pending' FROM b_products
UNION ALL SELECT 'orders', order_id, order_date, status, total_amount, TIMESTAMP '2001-08-02 00:00:00', 'pending' FROM b_orders"""),
)
def o21(spark, d):
    """All three raw tables, written as CSV, ingested, and read from the raw layer."""
    layer = {}
    for name, (adapter, schema, dates) in _RAW.items():
        raw_csv = scratch.new_dir(spark, f"raw-{name}")
        columns = [c.split()[0] for c in schema.split(", ")]
        files.write_csv(adapter(spark, d).select(*columns), raw_csv)
        out = scratch.new_dir(spark, f"bronze-{name}")
        layer[name] = files.ingest(spark, raw_csv, out, schema, dates, NOW, scratch.new_dir(spark, f"rejects-{name}"))

    def rows(name, key, date, label, amount):
        return layer[name].select(
            F.lit(name).alias("source_table"),
            F.col(key).alias("record_key"),
            date.cast("date").alias("record_date"),
            F.col(label).alias("label"),
            amount.cast("double").alias("amount"),
            "ingested_at",
            "data_quality_flag",
        )

    nothing = F.lit(None)
    return (
        rows("customers", "customer_id", F.col("registration_date"), "email", nothing)
        .unionByName(rows("products", "product_id", nothing, "product_name", F.col("price")))
        .unionByName(rows("orders", "order_id", F.col("order_date"), "status", F.col("total_amount")))
    )


@query(
    "o22_order_rollup",
    """WITH line AS (
  SELECT 'ORD-' || CASE WHEN l_orderkey < 100000000 THEN lpad(CAST(l_orderkey AS VARCHAR), 8, '0')
      ELSE CAST(l_orderkey AS VARCHAR) END AS order_id,
    CAST(floor(l_extendedprice / l_quantity * 100) AS DOUBLE) / 100 * CAST(l_quantity AS INT) AS gross,
    CAST(floor(l_discount * 100 + 0.5) AS INT) AS pct FROM lineitem),
priced AS (SELECT order_id, gross, CAST(floor(gross * pct / CAST(100 AS DOUBLE) * 100 + 0.5) AS DOUBLE) / 100 AS off FROM line),
grouped AS (SELECT order_id, count(*) AS line_count, SUM(CAST(floor(CAST(floor((gross - off) * 100 + 0.5) AS DOUBLE) / 100
    * 100 + 0.5) AS BIGINT)) AS c FROM priced GROUP BY order_id)
SELECT order_id, line_count, CAST(c AS DOUBLE) / 100 AS subtotal,
  CAST(floor(CAST(c AS DOUBLE) * CAST(0.08 AS DOUBLE) + 0.5) AS DOUBLE) / 100 AS tax, CAST(0 AS DOUBLE) AS shipping_cost,
  (CAST(c AS DOUBLE) + floor(CAST(c AS DOUBLE) * CAST(0.08 AS DOUBLE) + 0.5)) / 100 AS total_amount
FROM grouped""",
)
def o22(spark, d):
    return rollup.order_totals(adapters.order_lines(spark, d))


@query(
    "o24_stage_metrics",
    sql("""SELECT 'customers_count' AS stage, count(*) AS records FROM b_customers
UNION ALL SELECT 'products_count', count(*) FROM b_products UNION ALL SELECT 'orders_count', count(*) FROM b_orders
UNION ALL SELECT 'records_enriched', count(*) FROM dag_orders"""),
)
def o24(spark, d):
    orders, customers, products = bronze(spark, d)
    return dag_tables.stage_metrics(
        {
            "customers_count": customers,
            "products_count": products,
            "orders_count": orders,
            "records_enriched": dag_orders(spark, d),
        }
    )


# ------------------------------------------------------------------- P


@query(
    "p1_table_stats",
    sql("""SELECT 'bronze' AS table_namespace, b_orders.order_source AS table_name, count(*) AS version_count,
  max(ingested_at) AS last_modified FROM b_orders GROUP BY order_source"""),
)
def p1(spark, d):
    """Arrivals stand for table versions: one per order, grouped by the source that sent it."""
    versions = adapters.orders(spark, d).select(
        F.lit("bronze").alias("table_namespace"),
        F.col("order_source").alias("table_name"),
        F.col("ingested_at").alias("last_updated"),
    )
    return catalogue.table_stats(versions)


@query(
    "p1_versioned_table_stats",
    vsql("""SELECT 'bronze' AS table_namespace, 'orders' AS table_name, CAST(2 AS BIGINT) AS version_count,
  TIMESTAMP '2001-08-02 00:00:00' AS last_modified, (SELECT count(*) FROM v_base) + (SELECT count(*) FROM v_delta)
  AS rows_written"""),
)
def p1_versions(spark, d):
    s = states(spark, d)
    snapshots = s.table.snapshots().where(F.col("commit_id").isin(s.load, s.main))
    written = snapshots.agg(F.sum("changed_rows")).scalar()
    stats = catalogue.table_stats(catalogue.table_versions(snapshots, "bronze", "orders"))
    return stats.withColumn("rows_written", written)


@query(
    "p2_audit_log",
    sql("""SELECT 'silver.orders_enriched' AS table_name, data_quality_flag AS operation, 'marketlane' AS username,
  TIMESTAMP '2001-08-02 00:00:00' AS timestamp,
  '{"order_id":"' || order_id || '","quantity":' || CAST(quantity AS VARCHAR) || '}' AS details
FROM silver WHERE data_quality_flag <> 'VALID'"""),
)
def p2(spark, d):
    """One audit row per rejected order, appended to the stored trail."""
    rejected = silver_orders(spark, d).where(F.col("data_quality_flag") != "VALID")
    trail = scratch.new_dir(spark, "audit")
    catalogue.audit_entries(
        rejected, "silver.orders_enriched", F.col("data_quality_flag"), "marketlane", NOW, ["order_id", "quantity"]
    ).write.mode("append").parquet(trail)
    return spark.read.parquet(trail)


@query(
    "p3_namespace_properties",
    sql(
        """SELECT * FROM given UNION ALL
SELECT * FROM wanted w WHERE NOT EXISTS (FROM given g WHERE g.namespace = w.namespace)""",
        given="""SELECT 'prod' AS catalog_name, category AS namespace, 'products' AS property_key,
  CAST(count(*) AS VARCHAR) AS property_value FROM b_products GROUP BY category""",
        wanted="""SELECT 'prod' AS catalog_name, coalesce(category, 'none') AS namespace, 'products' AS property_key,
  CAST(count(*) AS VARCHAR) AS property_value FROM job_orders GROUP BY coalesce(category, 'none')""",
    ),
)
def p3(spark, d):
    """Product counts per category as properties; order counts fill in for categories that have none."""
    from marketlane.registry.products import job_orders

    def counted(df, namespace):
        return df.groupBy(namespace.alias("namespace")).agg(F.count(F.lit(1)).cast("string").alias("property_value")).select(
            F.lit("prod").alias("catalog_name"), "namespace", F.lit("products").alias("property_key"), "property_value"
        )

    given = counted(adapters.products(spark, d), F.col("category"))
    wanted = counted(job_orders(spark, d), F.coalesce("category", F.lit("none")))
    return catalogue.set_absent_properties(given, wanted)
