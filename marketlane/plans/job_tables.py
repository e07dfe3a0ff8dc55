"""The batch job's tables: a narrow enriched order table, two summaries, three reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlane.functions import columns as C
from marketlane.functions.money import money_avg, money_sum
from marketlane.operators.joins import lookup_join

HIGH_ORDER = 500


def orders_enriched(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    now: dt.datetime,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Orders whose status is set and not literally ``cancelled``, with segment, state and price."""
    kept = orders.where(F.col("status") != "cancelled")
    buyers = customers.select("customer_id", "customer_segment", "state")
    goods = products.select("product_id", "category", F.col("price").alias("unit_price"))
    joined = lookup_join(kept, buyers, "customer_id", "order_id", broadcast_rows)
    joined = lookup_join(joined, goods, "product_id", "order_id", broadcast_rows, kept)
    return joined.select(
        "order_id",
        "customer_id",
        "order_date",
        "product_id",
        "quantity",
        "status",
        "total_amount",
        "customer_segment",
        "state",
        "category",
        "unit_price",
        F.year("order_date").alias("order_year"),
        F.month("order_date").alias("order_month"),
        (F.col("quantity") * F.col("unit_price")).alias("calculated_revenue"),
        F.when(F.col("total_amount") > HIGH_ORDER, "High").otherwise("Normal").alias("order_value_tier"),
        C.ts_lit(now).alias("processed_at"),
    )


def daily_sales(enriched: DataFrame) -> DataFrame:
    return enriched.groupBy("order_date").agg(
        F.countDistinct("order_id").alias("num_orders"),
        F.countDistinct("customer_id").alias("unique_customers"),
        money_sum("total_amount").alias("total_revenue"),
        money_avg("total_amount").alias("avg_order_value"),
        F.sum("quantity").alias("total_items_sold"),
    ).orderBy(F.col("order_date").desc_nulls_last())


def product_performance(enriched: DataFrame) -> DataFrame:
    return (
        enriched.groupBy("product_id", "category")
        .agg(
            F.count("order_id").alias("num_orders"),
            F.sum("quantity").alias("units_sold"),
            money_sum("calculated_revenue").alias("total_revenue"),
            money_avg("unit_price").alias("avg_price"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_last(), "product_id")
    )


def top_customers(enriched: DataFrame, k: int = 10) -> DataFrame:
    return (
        enriched.groupBy("customer_id", "customer_segment")
        .agg(F.count("order_id").alias("num_orders"), money_sum("total_amount").alias("total_revenue"))
        .orderBy(
            F.col("total_revenue").desc_nulls_last(),
            F.col("customer_id").asc_nulls_last(),
            F.col("customer_segment").asc_nulls_last(),
        )
        .limit(k)
    )


def revenue_by_category(enriched: DataFrame) -> DataFrame:
    return (
        enriched.groupBy("category")
        .agg(
            F.countDistinct("product_id").alias("num_products"),
            money_sum("calculated_revenue").alias("total_revenue"),
            money_avg("unit_price").alias("avg_price"),
        )
        .orderBy(F.col("total_revenue").desc_nulls_last(), F.col("category").asc_nulls_last())
    )


def monthly_trend(enriched: DataFrame) -> DataFrame:
    return (
        enriched.groupBy("order_year", "order_month")
        .agg(F.count("order_id").alias("orders"), money_sum("total_amount").alias("revenue"))
        .orderBy("order_year", "order_month")
    )
