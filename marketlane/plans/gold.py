"""Reporting layer: daily sales, customer scoring and product performance."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlane import schemas, scratch
from marketlane.functions import columns as C
from marketlane.functions.money import (
    of_steps,
    count_where,
    money_avg,
    money_sum,
    money_sum_where,
    percent_where,
    ratio_avg,
    steps,
)
from marketlane.operators.aggregate import with_distinct_counts
from marketlane.operators.ranking import score_scales

# Reporting windows and thresholds.
RECENT_DAYS = 30
GROWTH_BAR = 1.1
REORDER_DAYS = 7
TILES = 5


# What each report reads of the cleaned orders; a stored copy needs no other columns.
DAILY_READS = [
    "order_date", "order_id", "customer_id", "quantity", "is_first_order", "is_repeat_customer", "total_amount",
    "status", "profit_margin_pct", "discount_amount", "is_weekend", "channel_category", "payment_method",
    "customer_segment", "data_quality_flag",
]
CUSTOMER_READS = [
    "customer_id", "customer_name", "customer_email", "customer_segment", "customer_city", "customer_state",
    "order_id", "order_date", "total_amount", "product_category", "payment_method", "order_source",
    "data_quality_flag",
]
PRODUCT_READS = [
    "product_id", "product_name", "product_category", "order_id", "customer_id", "order_date", "quantity",
    "total_amount", "unit_price", "data_quality_flag",
]


def _shaped(df: DataFrame, ddl: str, derived: dict[str, Column]) -> DataFrame:
    """The columns of a declared table, those in ``derived`` computed."""
    return df.select(
        *[derived[c].alias(c) if c in derived else F.col(c) for c in schemas.names(ddl)]
    )


def valid_rows(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("data_quality_flag") == C.VALID)


def daily_sales(silver: DataFrame, now: dt.datetime) -> DataFrame:
    """Sales of each day. ``silver`` is read twice: pass the stored table."""
    total = F.col("total_amount")
    channel, segment, paid = F.col("channel_category"), F.col("customer_segment"), F.col("payment_method")
    measures = {
        "total_items_sold": F.sum("quantity"),
        "new_customers": count_where(F.col("is_first_order")),
        "repeat_customers": count_where(F.col("is_repeat_customer")),
        "total_revenue": money_sum(total),
        "avg_order_value": money_avg(total),
        "max_order_value": F.max(total),
        "completion_rate": percent_where(F.col("status") == "COMPLETED"),
        "avg_profit_margin": ratio_avg("profit_margin_pct"),
        "total_discounts": money_sum("discount_amount"),
        "weekend_order_pct": percent_where(F.col("is_weekend")),
        "online_revenue": money_sum_where(channel == "Online", total),
        "instore_revenue": money_sum_where(channel == "In-Store", total),
        "partner_revenue": money_sum_where(channel == "Partner", total),
        "credit_card_orders": count_where(paid == "Credit Card"),
        "paypal_orders": count_where(paid == "PayPal"),
        "other_payment_orders": count_where(~paid.isin("Credit Card", "PayPal")),
        "premium_revenue": money_sum_where(segment == "Premium", total),
        "standard_revenue": money_sum_where(segment == "Standard", total),
        "basic_revenue": money_sum_where(segment == "Basic", total),
    }
    rows = valid_rows(silver).withColumnRenamed("order_date", "sale_date")
    daily = with_distinct_counts(
        rows, ["sale_date"], measures, {"total_orders": "order_id", "unique_customers": "customer_id"}
    )
    derived = {
        "sale_year": F.year("sale_date"),
        "sale_month": F.month("sale_date"),
        "calculated_at": C.ts_lit(now),
    }
    return _shaped(daily, schemas.GOLD_DAILY, derived)


def favourites(rows: DataFrame, key: str, choices: dict[str, str], uses: str | None = None) -> DataFrame:
    """The most frequent value of several columns per ``key``, in one pass.

    ``choices`` maps an output name to a column. Equal counts go to the value
    that sorts first, NULL last. Counting comes first, so a key with very many
    rows is one counter per distinct value by the time it is shuffled. ``uses``
    names how many rows a row stands for.
    """
    names = list(choices)
    tagged = F.array(
        *[
            F.struct(F.lit(i).alias("choice"), F.col(choices[out]).cast("string").alias("value"))
            for i, out in enumerate(names)
        ]
    )
    counted = (
        rows.select(key, F.explode(tagged).alias("c"), *([uses] if uses else []))
        .groupBy(key, "c.choice", "c.value")
        .agg((F.sum(uses) if uses else F.count(F.lit(1))).alias("uses"))
    )
    preference = F.struct(-F.col("uses"), F.col("value").isNull(), F.col("value"))
    return counted.groupBy(key).agg(
        *[
            F.min(F.when(F.col("choice") == i, preference)).getField("value").alias(out)
            for i, out in enumerate(names)
        ]
    )


def customer_metrics(silver: DataFrame, as_of: dt.date) -> DataFrame:
    return (
        valid_rows(silver)
        .groupBy(
            "customer_id",
            "customer_name",
            "customer_email",
            "customer_segment",
            "customer_city",
            "customer_state",
        )
        .agg(
            F.countDistinct("order_id").alias("total_orders"),
            money_sum("total_amount").alias("lifetime_value"),
            money_avg("total_amount").alias("avg_order_value"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
        .withColumn("days_since_last_order", F.datediff(C.date_lit(as_of), F.col("last_order_date")))
    )


def customer_360(
    silver: DataFrame,
    customers: DataFrame,
    as_of: dt.date,
    now: dt.datetime,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """RFM scores, ranks, favourites and churn of every customer with a valid order.

    ``silver`` is read twice (metrics and favourites): pass the stored table.
    A customer whose details changed between orders has one row per version of
    the details; ``_variant`` tells these rows apart.
    """
    liked = favourites(
        valid_rows(silver),
        "customer_id",
        {
            "favorite_category": "product_category",
            "favorite_payment_method": "payment_method",
            "favorite_channel": "order_source",
        },
    )
    return scored_customers(customer_metrics(silver, as_of), liked, customers, now, rows_per_slice)


def scored_customers(
    counted: DataFrame, liked: DataFrame, customers: DataFrame, now: dt.datetime, rows_per_slice: int | None = None
) -> DataFrame:
    """Scores, ranks and churn from the metrics and favourites of customers."""
    described_by = ["customer_name", "customer_email", "customer_segment", "customer_city", "customer_state"]
    metrics = scratch.durable(
        counted.withColumn("_variant", F.xxhash64(*described_by)), "customer-metrics"
    )
    scores = score_scales(
        metrics,
        ["customer_id", "_variant"],
        scales={
            "recency": (None, "days_since_last_order", False),
            "frequency": (None, "total_orders", True),
            "value": (None, "lifetime_value", True),
            "segment": ("customer_segment", "lifetime_value", True),
        },
        tiles={
            "recency_score": ("recency", TILES),
            "frequency_score": ("frequency", TILES),
            "monetary_score": ("value", TILES),
        },
        ranks={"lifetime_value_rank": "value", "segment_rank": "segment"},
        rows_per_slice=rows_per_slice,
    )
    registered = customers.select("customer_id", "registration_date")
    joined = scores.join(liked, "customer_id", "left").join(registered, "customer_id", "left")
    score_sum = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    derived = {
        "customer_tier": C.spend_tier(F.col("lifetime_value")),
        "churn_risk_score": C.churn_score(F.col("days_since_last_order")),
        "rfm_score": score_sum.cast("double") / F.lit(3.0),
        "last_updated": C.ts_lit(now),
    }
    return _shaped(joined, schemas.GOLD_CUSTOMERS, derived)


def trend_windows(as_of: dt.date) -> tuple[Column, Column]:
    """Whether an order lies in the last 30 days, and in the 30 days before them."""
    day = F.col("order_date")
    recent_from = as_of - dt.timedelta(days=RECENT_DAYS)
    before_from = as_of - dt.timedelta(days=2 * RECENT_DAYS)
    before_to = as_of - dt.timedelta(days=RECENT_DAYS + 1)
    return day >= C.date_lit(recent_from), day.between(C.date_lit(before_from), C.date_lit(before_to))


def product_metrics(silver: DataFrame, as_of: dt.date) -> DataFrame:
    """Totals and 30-day trends per product. ``silver`` is read twice: pass the stored table.

    A product renamed between orders has a row per name, each with the trend of
    the product as a whole.
    """
    total = F.col("total_amount")
    recent, before = trend_windows(as_of)
    totals = with_distinct_counts(
        valid_rows(silver),
        ["product_id", "product_name", "product_category"],
        {
            "units_sold": F.sum("quantity"),
            "total_revenue": money_sum(total),
            "avg_selling_price": money_avg("unit_price"),
            "_recent": F.sum(F.when(recent, steps(total)).otherwise(F.lit(0).cast("decimal(20,0)"))),
            "_before": F.sum(F.when(before, steps(total)).otherwise(F.lit(0).cast("decimal(20,0)"))),
            "_units": F.sum(F.when(recent, F.col("quantity")).otherwise(0)),
        },
        {"total_orders": "order_id", "unique_customers": "customer_id"},
    )
    return with_trends(totals)


def with_trends(totals: DataFrame) -> DataFrame:
    """Totals of each name of a product with the trend of the product as a whole."""
    whole = Window.partitionBy("product_id")  # as many rows as the product had names
    return totals.select(
        "product_id",
        "product_name",
        "product_category",
        "total_orders",
        "units_sold",
        "total_revenue",
        "avg_selling_price",
        "unique_customers",
        of_steps(F.sum("_recent").over(whole)).alias("revenue_last_30d"),
        of_steps(F.sum("_before").over(whole)).alias("revenue_prev_30d"),
        F.sum("_units").over(whole).alias("units_last_30d"),
    )


def growth_pct(recent: Column, before: Column) -> Column:
    return F.when(F.coalesce(before, F.lit(0.0)) != 0, (recent - before) / before * F.lit(100.0))


def quadrant(recent: Column, before: Column, mean: Column) -> Column:
    growing = recent > F.coalesce(before, F.lit(0.0)) * F.lit(GROWTH_BAR)
    large = recent > mean
    return (
        F.when(large & growing, "Star")
        .when(large, "Cash Cow")
        .when(growing, "Question Mark")
        .otherwise("Dog")
    )


def days_of_stock(stock: Column, units: Column) -> Column:
    """Whole days the stock lasts at the recent daily rate; NULL when nothing sold."""
    return F.when(
        F.coalesce(units, F.lit(0)) != 0,
        (stock.cast("double") / (units.cast("double") / F.lit(float(RECENT_DAYS)))).cast("bigint"),
    )


def reorder_due(stock: Column, units: Column) -> Column:
    rate = units.cast("double") / F.lit(float(RECENT_DAYS))
    due = (F.coalesce(units, F.lit(0)) > 0) & (stock.cast("double") < rate * F.lit(float(REORDER_DAYS)))
    return F.coalesce(due, F.lit(False))


def product_performance(
    silver: DataFrame,
    products: DataFrame,
    as_of: dt.date,
    now: dt.datetime,
    rows_per_slice: int | None = None,
) -> DataFrame:
    """Revenue, growth quadrant, ranks and stock cover per product."""
    return scored_products(product_metrics(silver, as_of), products, now, rows_per_slice)


def scored_products(
    counted: DataFrame, products: DataFrame, now: dt.datetime, rows_per_slice: int | None = None
) -> DataFrame:
    """Quadrants, ranks and stock cover from the metrics of products."""
    metrics = scratch.durable(
        counted.withColumn("_variant", F.xxhash64("product_name", "product_category")),
        "product-metrics",
    )
    ranks = score_scales(
        metrics,
        ["product_id", "_variant"],
        scales={
            "all": (None, "total_revenue", True),
            "category": ("product_category", "total_revenue", True),
        },
        ranks={"revenue_rank": "all", "category_rank": "category"},
        rows_per_slice=rows_per_slice,
    )
    stock = products.where(F.col("stock_quantity").isNotNull()).select(
        "product_id", F.col("stock_quantity").alias("current_stock")
    )
    recent, before, units = F.col("revenue_last_30d"), F.col("revenue_prev_30d"), F.col("units_last_30d")
    mean = metrics.agg(
        (of_steps(F.sum(steps(recent))) / F.count(recent)).alias("mean")
    ).scalar()
    joined = ranks.join(stock, "product_id", "left")
    derived = {
        "revenue_growth_pct": growth_pct(recent, before),
        "performance_quadrant": quadrant(recent, before, mean),
        "days_of_stock_left": days_of_stock(F.col("current_stock"), units),
        "reorder_recommended": reorder_due(F.col("current_stock"), units),
        "last_calculated": C.ts_lit(now),
    }
    return _shaped(joined, schemas.GOLD_PRODUCTS, derived)
