"""The reporting layer kept up to date by the days that changed.

Beside the cleaned orders, stored by period, lie the daily report and the
aggregates of each day that customer scoring and product performance merge.
``refresh`` takes in new versions of orders, reads the periods they touch and
computes those anew. The reports equal those built from all orders.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlane import scratch
from marketlane.functions import columns as C
from marketlane.functions.money import of_steps, steps
from marketlane.operators import daily
from marketlane.operators.daily import DayTable, Partial
from marketlane.plans import gold

_DAY = "order_date"
_BUYER = ("customer_id", "customer_name", "customer_email", "customer_segment", "customer_city", "customer_state")
_PRODUCT = ("product_id", "product_name", "product_category")
_CHOICES = {"favorite_category": "product_category", "favorite_payment_method": "payment_method", "favorite_channel": "order_source"}


def _partials() -> dict[str, Partial]:
    # Each order's sums stand beside what is counted, so that a row is stored and shuffled once for both.
    total = steps("total_amount")
    return {
        "customers": Partial(
            (*_BUYER, "order_id"), {"_total": total, "_amounts": F.when(F.col("total_amount").isNotNull(), 1).otherwise(0)}
        ),
        "choices": Partial(("customer_id", *_CHOICES.values()), {"_uses": F.lit(1)}),
        "products": Partial(
            (*_PRODUCT, "order_id", "customer_id"),
            {
                "_units": F.col("quantity"),
                "_total": total,
                "_price": steps("unit_price"),
                "_prices": F.when(F.col("unit_price").isNotNull(), 1).otherwise(0),
            },
        ),
    }


@dataclass(frozen=True)
class GoldParts:
    silver: DayTable
    days: DayTable  # the daily report
    parts: dict[str, DayTable]

    def __getitem__(self, name: str) -> DataFrame:
        return self.parts[name].rows


def build(silver: DataFrame, now: dt.datetime, per: str = daily.DAY) -> GoldParts:
    """All orders laid out by period, and what the reports need of each day."""
    rows = daily.store(silver, _DAY, "silver-days", per)
    days = daily.store(gold.daily_sales(rows.rows, now), "sale_date", "daily", per)
    valid = gold.valid_rows(rows.rows)
    parts = {name: daily.store_partial(p, valid, _DAY, name, per) for name, p in _partials().items()}
    return GoldParts(rows, days, parts)


def refresh(made: GoldParts, arrived: DataFrame, keys: list[str], now: dt.datetime) -> list[dt.date | None]:
    """Take in new versions of cleaned orders; returns the periods that were computed anew."""
    periods = daily.upsert(made.silver, arrived, keys)
    rows = made.silver.within(periods)
    with scratch.held(gold.daily_sales(rows, now), "daily") as fresh:
        daily.replace(made.days, fresh, periods)
    valid = gold.valid_rows(rows)
    for name, partial in _partials().items():
        daily.refresh(made.parts[name], partial, valid, periods)
    return periods


def customer_metrics(made: GoldParts, as_of: dt.date) -> DataFrame:
    counted = made["customers"].groupBy(*_BUYER).agg(
        F.countDistinct("order_id").alias("total_orders"),
        of_steps(F.sum("_total")).alias("lifetime_value"),
        (of_steps(F.sum("_total")) / F.sum("_amounts")).alias("avg_order_value"),
        F.min(_DAY).alias("first_order_date"),
        F.max(_DAY).alias("last_order_date"),
    )
    return counted.withColumn("days_since_last_order", F.datediff(C.date_lit(as_of), F.col("last_order_date")))


def customer_360(made: GoldParts, customers: DataFrame, as_of: dt.date, now: dt.datetime) -> DataFrame:
    liked = gold.favourites(made["choices"], "customer_id", _CHOICES, uses="_uses")
    return gold.scored_customers(customer_metrics(made, as_of), liked, customers, now)


def product_metrics(made: GoldParts, as_of: dt.date) -> DataFrame:
    recent, before = gold.trend_windows(as_of)
    none = F.lit(0).cast("decimal(20,0)")
    sums = made["products"].groupBy(*_PRODUCT).agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.sum("_units").alias("units_sold"),
        of_steps(F.sum("_total")).alias("total_revenue"),
        (of_steps(F.sum("_price")) / F.sum("_prices")).alias("avg_selling_price"),
        F.sum(F.when(recent, F.col("_total")).otherwise(none)).alias("_recent"),
        F.sum(F.when(before, F.col("_total")).otherwise(none)).alias("_before"),
        F.sum(F.when(recent, F.col("_units")).otherwise(0)).alias("_units"),
    )
    sets = {"unique_customers": (made["products"], "customer_id")}
    return gold.with_trends(daily.with_distinct(sums, list(_PRODUCT), sets))


def product_performance(made: GoldParts, products: DataFrame, as_of: dt.date, now: dt.datetime) -> DataFrame:
    return gold.scored_products(product_metrics(made, as_of), products, now)
