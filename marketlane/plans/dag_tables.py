"""The daily run's tables. NULL handling follows dataframe habits rather than SQL's:

a NULL status counts as not cancelled, groups with a NULL key are left out, and
the sum of nothing is 0.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlane.functions.money import money_sum
from marketlane.operators.joins import lookup_join

HIGH_ORDER = 500


def orders_enriched(
    orders: DataFrame, customers: DataFrame, products: DataFrame, broadcast_rows: int | None = None
) -> DataFrame:
    kept = orders.where(F.col("status").isNull() | (F.col("status") != "cancelled"))
    buyers = customers.select("customer_id", "customer_segment", "state")
    goods = products.select("product_id", "category", "price")
    joined = lookup_join(kept, buyers, "customer_id", "order_id", broadcast_rows)
    joined = lookup_join(joined, goods, "product_id", "order_id", broadcast_rows, kept)
    day = F.col("order_date")
    return joined.select(
        *orders.columns,
        F.year(day).alias("order_year"),
        F.month(day).alias("order_month"),
        F.quarter(day).alias("order_quarter"),
        "customer_segment",
        "state",
        "category",
        "price",
        F.col("price").alias("unit_price"),
        (F.col("quantity") * F.col("price")).alias("revenue"),
        F.coalesce(F.col("total_amount") > HIGH_ORDER, F.lit(False)).alias("is_high_value"),
    )


def _or_zero(total: Column) -> Column:
    return F.coalesce(total, F.lit(0.0))


def daily_sales(enriched: DataFrame) -> DataFrame:
    return (
        enriched.where(F.col("order_date").isNotNull())
        .groupBy(F.col("order_date").alias("date"))
        .agg(
            F.count("order_id").alias("num_orders"),
            _or_zero(money_sum("total_amount")).alias("total_revenue"),
            F.countDistinct("customer_id").alias("unique_customers"),
            F.coalesce(F.sum("quantity"), F.lit(0)).alias("total_items"),
        )
        .withColumn("avg_order_value", F.try_divide("total_revenue", F.col("num_orders").cast("double")))
    )


def customer_metrics(enriched: DataFrame) -> DataFrame:
    return (
        enriched.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            _or_zero(money_sum("total_amount")).alias("lifetime_value"),
            F.min("order_date").alias("first_order"),
            F.max("order_date").alias("last_order"),
        )
        .withColumn("days_active", F.datediff("last_order", "first_order"))
    )


def product_performance(enriched: DataFrame) -> DataFrame:
    return (
        enriched.where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.count("order_id").alias("num_orders"),
            F.coalesce(F.sum("quantity"), F.lit(0)).alias("units_sold"),
            _or_zero(money_sum("revenue")).alias("total_revenue"),
        )
        .orderBy(F.col("total_revenue").desc(), "product_id")
    )


def regional_sales(enriched: DataFrame) -> DataFrame:
    return (
        enriched.where(F.col("state").isNotNull())
        .groupBy("state")
        .agg(
            F.count("order_id").alias("num_orders"),
            _or_zero(money_sum("total_amount")).alias("total_revenue"),
            F.countDistinct("customer_id").alias("unique_customers"),
        )
        .orderBy(F.col("total_revenue").desc(), "state")
    )


def kpi_report(daily: DataFrame, customers: DataFrame, now: dt.datetime) -> DataFrame:
    """One row: revenue, orders, average order value, number of customers."""
    totals = daily.agg(
        F.coalesce(money_sum("total_revenue"), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(F.sum("num_orders"), F.lit(0)).alias("total_orders"),
    )
    return totals.select(
        F.lit(now.isoformat()).alias("generated_at"),
        "total_revenue",
        "total_orders",
        F.try_divide("total_revenue", F.col("total_orders").cast("double")).alias("avg_order_value"),
        customers.agg(F.count(F.lit(1)).alias("n")).scalar().alias("total_customers"),
    )


def stage_metrics(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each named table."""
    counted = [
        df.agg(F.lit(name).alias("stage"), F.count(F.lit(1)).alias("records")) for name, df in tables.items()
    ]
    result = counted[0]
    for part in counted[1:]:
        result = result.unionByName(part)
    return result


def top_region(regional: DataFrame) -> DataFrame:
    return regional.orderBy(F.col("total_revenue").desc(), "state").limit(1).select(
        F.col("state").alias("top_revenue_state")
    )
