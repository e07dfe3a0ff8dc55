"""Cleaned layer: orders with their customer and product, and customer profiles."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlane import schemas, scratch
from marketlane.functions import columns as C
from marketlane.functions.money import money_avg, money_sum
from marketlane.operators.joins import hot_keys, is_small, lookup_join, salted_join


def live_orders(orders: DataFrame) -> DataFrame:
    return orders.where(C.not_cancelled(F.col("status")) & F.col("order_id").isNotNull())


def customer_history(orders: DataFrame) -> DataFrame:
    """First order day and number of orders of every known buyer."""
    return (
        live_orders(orders)
        .where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(F.min("order_date").alias("first_order_date"), F.count("order_id").alias("lifetime_orders"))
    )


def _customer_columns(customers: DataFrame) -> DataFrame:
    return customers.where(F.col("customer_id").isNotNull()).select(
        "customer_id",
        C.full_name(F.col("first_name"), F.col("last_name")).alias("customer_name"),
        C.clean_email(F.col("email")).alias("customer_email"),
        "customer_segment",
        F.col("city").alias("customer_city"),
        F.col("state").alias("customer_state"),
        F.lit(True).alias("_known_customer"),
    )


def _product_columns(products: DataFrame) -> DataFrame:
    return products.where(F.col("product_id").isNotNull()).select(
        "product_id",
        "product_name",
        F.col("category").alias("product_category"),
        F.col("price").alias("unit_price"),
        F.lit(True).alias("_known_product"),
    )


def _order_columns(now: dt.datetime) -> dict[str, Column]:
    """Columns that depend on the order, its customer and its product only."""
    total, quantity, price = F.col("total_amount"), F.col("quantity"), F.col("unit_price")
    return {
        **C.calendar(F.col("order_date")),
        "status": C.status_code(F.col("status")),
        "payment_method": F.trim("payment_method"),
        "channel_category": C.channel(F.col("order_source")),
        "order_source": F.trim("order_source"),
        "subtotal": quantity * price,
        "discount_amount": C.discount(quantity * price, total),
        "tax_amount": total * F.lit(C.TAX_RATE),
        "shipping_cost": C.shipping(total),
        "profit_margin_pct": C.margin_pct(total, quantity, price),
        "order_value_tier": C.order_tier(total),
        "data_quality_flag": C.quality_flag(
            total,
            quantity,
            F.col("_known_product").isNotNull(),
            F.col("_known_customer").isNotNull(),
        ),
        "processed_at": C.ts_lit(now),
    }


def enrich_orders(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    now: dt.datetime,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Every charged order that was not cancelled, with its customer and product.

    A buyer's history is aggregated and joined back rather than computed in a
    window, since a window would put all orders of one buyer into one task.
    History and customer meet first, so orders are joined by buyer only once.
    The history also tells which buyers are hot, so it is stored.
    """
    fact = live_orders(orders).where(F.col("total_amount") > 0)
    history = scratch.durable(customer_history(orders), "customer-history")
    buyers = history.join(_customer_columns(customers), "customer_id", "left")
    # The stored history is measured first, so the join is only measured when it is cheap to make.
    if is_small(history, broadcast_rows) and is_small(buyers, broadcast_rows):
        joined = fact.join(F.broadcast(buyers), "customer_id", "left")
    else:
        hot = scratch.durable(hot_keys(history, "customer_id", "lifetime_orders"), "hot-keys")
        joined = salted_join(fact, buyers, "customer_id", hot, "order_id")
    joined = lookup_join(joined, _product_columns(products), "product_id", "order_id", broadcast_rows, fact)

    lifetime = F.coalesce(F.col("lifetime_orders"), F.lit(1).cast("bigint"))
    derived = {
        **_order_columns(now),
        "customer_lifetime_orders": lifetime,
        "customer_value_tier": C.loyalty_tier(lifetime),
        "is_first_order": F.coalesce(F.col("order_date") == F.col("first_order_date"), F.lit(False)),
        "is_repeat_customer": lifetime > 1,
    }
    return joined.select(
        *[derived[c].alias(c) if c in derived else F.col(c) for c in schemas.names(schemas.SILVER_ORDERS)]
    )


def arrivals(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    since: Column,
    now: dt.datetime,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Orders that arrived after ``since``, shaped for the upsert into the cleaned orders.

    The history columns take their defaults: a late order counts as the only
    one of a new buyer until the table is next rebuilt.
    """
    fact = live_orders(orders).where((F.col("total_amount") > 0) & (F.col("ingested_at") > since))
    joined = lookup_join(fact, _customer_columns(customers), "customer_id", "order_id", broadcast_rows)
    joined = lookup_join(joined, _product_columns(products), "product_id", "order_id", broadcast_rows, fact)
    derived = {
        **_order_columns(now),
        "customer_lifetime_orders": F.lit(1).cast("bigint"),
        "customer_value_tier": F.lit("New"),
        "is_first_order": F.lit(False),
        "is_repeat_customer": F.lit(False),
    }
    return joined.select(
        *[derived[c].alias(c) if c in derived else F.col(c) for c in schemas.names(schemas.SILVER_ORDERS)]
    )


def customer_profiles(
    customers: DataFrame, orders: DataFrame, as_of: dt.date, now: dt.datetime
) -> DataFrame:
    """One row per reachable customer with order totals, spend tier and churn score.

    Orders are aggregated per buyer before the join, so a buyer with very many
    orders reaches the join as one row.
    """
    kept = orders.where(C.not_cancelled(F.col("status")) & (F.col("total_amount") > 0))
    totals = kept.groupBy("customer_id").agg(
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.countDistinct("order_id").alias("total_orders"),
        money_sum("total_amount").alias("lifetime_value"),
        money_avg("total_amount").alias("avg_order_value"),
    )
    reachable = customers.where(F.col("customer_id").isNotNull() & F.col("email").isNotNull())
    joined = reachable.join(totals, "customer_id", "left")
    idle_days = F.datediff(C.date_lit(as_of), F.col("last_order_date"))
    return joined.select(
        "customer_id",
        C.full_name(F.col("first_name"), F.col("last_name")).alias("customer_name"),
        C.clean_email(F.col("email")).alias("customer_email"),
        "customer_segment",
        F.col("city").alias("customer_city"),
        F.col("state").alias("customer_state"),
        "registration_date",
        "first_order_date",
        "last_order_date",
        F.coalesce("total_orders", F.lit(0)).alias("total_orders"),
        "lifetime_value",
        "avg_order_value",
        C.spend_tier(F.col("lifetime_value")).alias("customer_tier"),
        C.churn_score(idle_days).alias("churn_risk_score"),
        F.lit(True).alias("is_active"),
        C.ts_lit(now).alias("updated_at"),
    )


def changed_customers(customers: DataFrame, since: Column, now: dt.datetime) -> DataFrame:
    """Customers that arrived after ``since``, shaped for the upsert into the profiles."""
    return customers.where((F.col("ingested_at") > since) & F.col("customer_id").isNotNull()).select(
        "customer_id",
        C.full_name(F.col("first_name"), F.col("last_name")).alias("customer_name"),
        C.clean_email(F.col("email")).alias("customer_email"),
        "customer_segment",
        F.col("city").alias("customer_city"),
        F.col("state").alias("customer_state"),
        "registration_date",
        F.lit(True).alias("is_active"),
        C.ts_lit(now).alias("updated_at"),
    )
