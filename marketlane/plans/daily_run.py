"""The whole run, from raw tables to reports, each layer written before the next reads it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from marketlane import schemas
from marketlane.operators import quality
from marketlane.plans import gold, kpi, silver
from marketlane.sources import files


def run(
    spark: SparkSession,
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    out: str,
    as_of: dt.date,
    now: dt.datetime,
    layouts: dict[str, tuple[str, ...]] | None = None,
) -> dict[str, DataFrame]:
    """Write every layer below ``out``; returns the tables read back, plus the check and figure reports.

    ``layouts`` replaces a table's partition columns, say where its days are
    too small for a folder each.
    """
    made: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame) -> DataFrame:
        ddl, partitions = schemas.TABLES[name]
        partitions = (layouts or {}).get(name, partitions)
        path = f"{out}/{name.replace('.', '/')}"
        files.write_parquet(df.select(*schemas.names(ddl)), path, partitions)
        made[name] = spark.read.schema(schemas.struct(ddl)).parquet(path)
        return made[name]

    bronze_orders = keep("bronze.orders", orders)
    bronze_customers = keep("bronze.customers", customers)
    bronze_products = keep("bronze.products", products)
    enriched = keep(
        "silver.orders_enriched", silver.enrich_orders(bronze_orders, bronze_customers, bronze_products, now)
    )
    keep("silver.customer_profiles", silver.customer_profiles(bronze_customers, bronze_orders, as_of, now))
    keep("gold.daily_sales_summary", gold.daily_sales(enriched, now))
    scored = keep("gold.customer_360", gold.customer_360(enriched, bronze_customers, as_of, now))
    ranked = keep("gold.product_performance", gold.product_performance(enriched, bronze_products, as_of, now))
    layers = quality.layer_counts(dict(made))
    made["checks"] = quality.check_rows(bronze_orders, "orders", quality.order_checks())
    made["flags"] = quality.flag_distribution(enriched)
    made["layers"] = layers
    made["figures"] = kpi.quick_view(enriched, scored, ranked, as_of)
    return made
