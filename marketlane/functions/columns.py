"""Derived columns shared by the order, customer and product tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Business rules of the retail model.
TAX_RATE = 0.08
COST_SHARE = 0.6
ONLINE_SOURCES = ("web", "mobile", "app")
STORE_SOURCES = ("store", "pos")
SHIPPING_STEPS = ((50, 10.0), (100, 5.0))
ORDER_TIERS = ((1000, "High Value"), (500, "Medium Value"), (100, "Low Value"))
LOYALTY_TIERS = ((10, "VIP"), (5, "Loyal"), (2, "Regular"))
SPEND_TIERS = ((5000, "VIP"), (2000, "High Value"), (500, "Medium Value"))
CHURN_STEPS = ((180, 0.8), (90, 0.5), (30, 0.2))
CHURN_FLOOR = 0.1
VALID = "VALID"


def date_lit(day: dt.date) -> Column:
    return F.lit(day).cast("date")


def ts_lit(moment: dt.datetime) -> Column:
    """A zone-free timestamp literal."""
    return F.lit(moment.isoformat(sep=" ")).cast(T.TimestampNTZType())


def first_step(value: Column, steps, beyond, otherwise) -> Column:
    """The label of the first step that ``beyond(value, limit)`` accepts."""
    chain = None
    for limit, label in steps:
        test = beyond(value, limit)
        chain = F.when(test, F.lit(label)) if chain is None else chain.when(test, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def over(value: Column, limit) -> Column:
    return value > F.lit(limit)


def at_least(value: Column, limit) -> Column:
    return value >= F.lit(limit)


def below(value: Column, limit) -> Column:
    return value < F.lit(limit)


def status_code(status: Column) -> Column:
    return F.upper(F.trim(status))


def not_cancelled(status: Column) -> Column:
    """Cancelled in any letter case or padding; NULL status is not kept."""
    return status_code(status) != F.lit("CANCELLED")


def calendar(day: Column) -> dict[str, Column]:
    weekday = F.dayofweek(day)
    return {
        "order_year": F.year(day),
        "order_month": F.month(day),
        "order_quarter": F.quarter(day),
        "day_of_week": weekday,
        "is_weekend": F.coalesce(weekday.isin(1, 7), F.lit(False)),
    }


def channel(source: Column) -> Column:
    name = F.lower(F.trim(source))
    return (
        F.when(name.isin(*ONLINE_SOURCES), "Online")
        .when(name.isin(*STORE_SOURCES), "In-Store")
        .otherwise("Partner")
    )


def discount(subtotal: Column, total: Column) -> Column:
    """What the list price exceeds the charge by, never negative.

    ``greatest`` skips NULL, so an unknown price gives 0.
    """
    return F.greatest(subtotal - total, F.lit(0.0))


def shipping(total: Column) -> Column:
    return first_step(total, SHIPPING_STEPS, below, 0.0)


def margin_pct(total: Column, quantity: Column, price: Column) -> Column:
    return F.when(total > 0, (total - quantity * price * F.lit(COST_SHARE)) / total * F.lit(100.0))


def order_tier(total: Column) -> Column:
    return first_step(total, ORDER_TIERS, over, "Minimal Value")


def loyalty_tier(orders: Column) -> Column:
    return first_step(orders, LOYALTY_TIERS, at_least, "New")


def spend_tier(value: Column) -> Column:
    return first_step(value, SPEND_TIERS, over, "Low Value")


def churn_score(days_since_last: Column) -> Column:
    return first_step(days_since_last, CHURN_STEPS, over, CHURN_FLOOR)


def full_name(first: Column, last: Column) -> Column:
    return F.concat(F.trim(first), F.lit(" "), F.trim(last))


def clean_email(email: Column) -> Column:
    return F.lower(F.trim(email))


def quality_flag(total: Column, quantity: Column, has_product: Column, has_customer: Column) -> Column:
    """First problem of an order row, or VALID."""
    return (
        F.when(total <= 0, "INVALID_AMOUNT")
        .when(quantity <= 0, "INVALID_QUANTITY")
        .when(~has_product, "MISSING_PRODUCT")
        .when(~has_customer, "MISSING_CUSTOMER")
        .otherwise(VALID)
    )
