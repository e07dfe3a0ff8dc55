"""Reading and writing files and catalog tables (groups A and B)."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlane import schemas, scratch
from marketlane.operators import inspect
from marketlane.plans import dag_tables
from marketlane.registry.base import NOW, query
from marketlane.registry.products import dag_orders, job_orders
from marketlane.registry.reference_sql import msum, sql
from marketlane.sources import adapters, files, tables


def fresh_namespaces(spark, names):
    """Namespaces nobody else uses; returns the suffix of their names."""
    suffix = f"_{uuid.uuid4().hex[:12]}"
    root = scratch.new_dir(spark, "warehouse")
    tables.create_namespaces(spark, root, [n + suffix for n in names])
    return suffix


@query("a1_csv_scan", sql("SELECT * FROM b_customers"))
def a1(spark, d):
    path = scratch.new_dir(spark, "customers-csv")
    files.write_csv(adapters.customers(spark, d), path)
    return files.read_csv(spark, path, schemas.BRONZE_CUSTOMERS)


@query(
    "a1_csv_scan_inferred",
    sql("SELECT product_id, product_name, category, price, stock_quantity FROM b_products"),
)
def a1_inferred(spark, d):
    path = scratch.new_dir(spark, "products-csv")
    files.write_csv(adapters.products(spark, d).drop("ingested_at"), path)
    return files.read_csv(spark, path)


@query(
    "a1_csv_quoted",
    """SELECT c_custkey, 'say "' || c_name || '", twice' || chr(10) || ' and, ""leave""' AS note,
  CASE WHEN c_custkey % 100 <> 7 THEN c_acctbal END AS balance, c_custkey % 100 = 7 AS rejected FROM customer""",
)
def a1_quoted(spark, d):
    note = F.concat(F.lit('say "'), "c_name", F.lit('", twice\n and, ""leave""'))
    balance = F.when(F.col("c_custkey") % 100 == 7, "n/a").otherwise(F.col("c_acctbal").cast("string"))
    path = scratch.new_dir(spark, "notes-csv")
    customers = files.read_parquet(spark, f"{d}/customer.parquet")
    files.write_csv(customers.select("c_custkey", note.alias("note"), balance.alias("balance")), path)
    read = files.read_csv(spark, path, "c_custkey BIGINT, note STRING, balance DOUBLE", malformed=True)
    return read.select("c_custkey", "note", "balance", F.col(files.MALFORMED).isNotNull().alias("rejected"))


@query("a2_parquet_scan", sql("SELECT o_orderkey, o_orderdate, o_totalprice FROM orders"))
def a2(spark, d):
    return files.read_parquet(spark, f"{d}/orders.parquet").select("o_orderkey", "o_orderdate", "o_totalprice")


@query("a3_table_scan", sql("SELECT * FROM b_products"))
def a3(spark, d):
    suffix = fresh_namespaces(spark, ["bronze"])
    tables.replace_table(adapters.products(spark, d), f"bronze{suffix}.products")
    return tables.scan(spark, f"bronze{suffix}.products")


@query(
    "a8_largest_files",
    sql("""SELECT count(*) AS record_count, TRUE AS falling, count(DISTINCT order_year) AS partitions FROM job_orders
WHERE order_year > 1900"""),
)
def a8(spark, d):
    path = scratch.new_dir(spark, "silver-files")
    files.write_parquet(job_orders(spark, d), path, ("order_year",))
    # Few enough partitions that the list names all files.
    listed = inspect.largest_files(files.read_parquet(spark, path), 1000)
    place = Window.orderBy(F.monotonically_increasing_id())
    falls = F.coalesce(F.lag("size_mb").over(place) >= F.col("size_mb"), F.lit(True))
    year = F.regexp_extract("file_path", "order_year=([0-9]+)", 1)
    return listed.select("*", falls.alias("falls"), year.alias("year")).where(F.col("year") != "").agg(
        F.sum("record_count").alias("record_count"),
        F.bool_and("falls").alias("falling"),
        F.countDistinct("year").alias("partitions"),
    )


@query(
    "a9_partition_stats",
    sql("SELECT order_year, order_month, count(*) AS record_count FROM job_orders GROUP BY order_year, order_month"),
)
def a9(spark, d):
    path = scratch.new_dir(spark, "partitioned")
    files.write_parquet(job_orders(spark, d), path, ("order_year", "order_month"))
    stats = inspect.partition_stats(files.read_parquet(spark, path), ["order_year", "order_month"])
    return stats.select("order_year", "order_month", "record_count")


@query("b1_csv_write", sql("SELECT * FROM b_orders"))
def b1(spark, d):
    path = scratch.new_dir(spark, "orders-csv")
    files.write_csv(adapters.orders(spark, d), path)
    return files.read_csv(spark, path, schemas.BRONZE_ORDERS)


@query("b2_parquet_overwrite", sql("SELECT * FROM dag_daily"))
def b2(spark, d):
    path = scratch.new_dir(spark, "daily")
    daily = dag_tables.daily_sales(dag_orders(spark, d))
    files.write_parquet(daily, path)
    files.write_parquet(daily, path)
    return files.read_parquet(spark, path)


@query("b3_replace_table", sql("SELECT * FROM b_customers"))
def b3(spark, d):
    suffix = fresh_namespaces(spark, ["bronze"])
    name = f"bronze{suffix}.customers"
    customers = adapters.customers(spark, d)
    tables.replace_table(customers.select("customer_id"), name)
    tables.replace_table(customers, name)
    return tables.scan(spark, name)


@query("b4_create_tables", sql("SELECT * FROM b_products"))
def b4(spark, d):
    suffix = fresh_namespaces(spark, ["bronze", "silver", "gold"])
    tables.create_all(spark, suffix)
    tables.create_all(spark, suffix)  # every table exists already, so nothing changes
    tables.insert(adapters.products(spark, d), f"bronze{suffix}.products")
    return tables.scan(spark, f"bronze{suffix}.products")


@query("b5_create_as_select", sql("SELECT * FROM job_orders"))
def b5(spark, d):
    suffix = fresh_namespaces(spark, ["silver"])
    name = f"silver{suffix}.orders_enriched"
    enriched = job_orders(spark, d)
    tables.create_as_select(enriched, name, ("order_year", "order_month"))
    tables.create_as_select(enriched.select("order_id"), name)  # exists, so no effect
    return tables.scan(spark, name)


@query("b6_insert_select", sql("SELECT * FROM b_orders UNION ALL SELECT * FROM b_orders"))
def b6(spark, d):
    suffix = fresh_namespaces(spark, ["bronze"])
    name = f"bronze{suffix}.orders"
    tables.create_table(spark, name, schemas.BRONZE_ORDERS)
    orders = adapters.orders(spark, d)
    tables.insert(orders, name)
    tables.insert(orders.select(*reversed(orders.columns)), name)
    return tables.scan(spark, name)


@query("b6_insert_overwrite_partitions", sql("SELECT * FROM job_orders"))
def b6_overwrite(spark, d):
    suffix = fresh_namespaces(spark, ["silver"])
    name = f"silver{suffix}.orders_enriched"
    enriched = scratch.durable(job_orders(spark, d), "job-orders")
    tables.replace_table(enriched, name, ("order_year",))
    tables.insert_overwrite(enriched, name)
    return tables.scan(spark, name)


@query(
    "b7_identity_partitions",
    sql("SELECT * FROM job_orders WHERE order_year = 2001 AND order_month = 7"),
)
def b7(spark, d):
    path = scratch.new_dir(spark, "by-month")
    files.write_parquet(job_orders(spark, d), path, ("order_year", "order_month"))
    return files.read_parquet(spark, path).where("order_year = 2001 AND order_month = 7")


@query(
    "b8_daily_partitions",
    sql(f"SELECT order_date, count(*) AS orders, {msum('total_amount')} AS revenue FROM b_orders "
        "WHERE order_date >= DATE '2001-07-01' GROUP BY order_date"),
)
def b8(spark, d):
    from marketlane.functions.money import money_sum

    path = scratch.new_dir(spark, "by-day")
    files.write_parquet(adapters.orders(spark, d), path, ("order_date",))
    recent = files.read_parquet(spark, path, schemas.BRONZE_ORDERS).where("order_date >= DATE '2001-07-01'")
    return recent.groupBy("order_date").agg(
        F.count(F.lit(1)).alias("orders"), money_sum("total_amount").alias("revenue")
    )


@query(
    "b9_namespaces",
    sql("SELECT 'bronze' AS namespace, count(*) AS row_count FROM b_customers UNION ALL "
        "SELECT 'silver', count(*) FROM job_orders UNION ALL SELECT 'gold', count(*) FROM dag_daily"),
)
def b9(spark, d):
    suffix = fresh_namespaces(spark, ["bronze", "silver", "gold"])
    parts = {
        "bronze": adapters.customers(spark, d),
        "silver": job_orders(spark, d),
        "gold": dag_tables.daily_sales(dag_orders(spark, d)),
    }
    counted = None
    for layer, df in parts.items():
        tables.replace_table(df, f"{layer}{suffix}.sample")
        row = tables.scan(spark, f"{layer}{suffix}.sample").agg(
            F.lit(layer).alias("namespace"), F.count(F.lit(1)).alias("row_count")
        )
        counted = row if counted is None else counted.unionByName(row)
    return counted


@query("b10_file_properties", "SELECT TRUE AS snappy, count(*) AS record_count FROM orders")
def b10(spark, d):
    """Files written with the declared compression carry it in their names."""
    path = scratch.new_dir(spark, "snappy")
    files.write_parquet(adapters.orders(spark, d), path)
    listed = inspect.files(files.read_parquet(spark, path))
    return listed.groupBy(F.col("file_path").endswith(".snappy.parquet").alias("snappy")).agg(
        F.sum("record_count").alias("record_count")
    )


@query(
    "b11_kpi_document",
    sql(f"""SELECT '2001-08-02T00:00:00' AS generated_at, coalesce({msum('total_revenue')}, 0.0) AS total_revenue,
  CAST(coalesce(sum(num_orders), 0) AS BIGINT) AS total_orders,
  coalesce({msum('total_revenue')}, 0.0) / nullif(sum(num_orders), 0) AS avg_order_value,
  (SELECT count(*) FROM dag_customers) AS total_customers FROM dag_daily"""),
)
def b11(spark, d):
    enriched = dag_orders(spark, d)
    report = dag_tables.kpi_report(dag_tables.daily_sales(enriched), dag_tables.customer_metrics(enriched), NOW)
    path = scratch.new_dir(spark, "kpi-report")
    files.write_json_report(report, path)
    return spark.read.schema(report.schema).json(path)
