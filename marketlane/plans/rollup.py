"""Order totals from order lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlane.functions.columns import TAX_RATE
from marketlane.functions.money import cents

COST_CAP = 0.7


def priced_lines(lines: DataFrame) -> DataFrame:
    """Discount and total of each line, in cents rounded half up."""
    gross = F.col("unit_price") * F.col("quantity")
    discount = cents(gross * F.col("discount_pct") / F.lit(100.0)).cast("double") / F.lit(100.0)
    total = cents(gross - discount).cast("double") / F.lit(100.0)
    return lines.withColumn("discount_amount", discount).withColumn("line_total", total)


def order_totals(lines: DataFrame) -> DataFrame:
    """Subtotal, tax, shipping and total per order.

    Shipping is an input (``shipping_cost``, 0 where the column is missing); an
    order carries the largest value given on its lines.
    """
    priced = priced_lines(lines)
    if "shipping_cost" not in priced.columns:
        priced = priced.withColumn("shipping_cost", F.lit(0.0))
    grouped = priced.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum(cents("line_total")).alias("_subtotal"),
        F.max(cents("shipping_cost")).alias("_shipping"),
    )
    tax = F.floor(F.col("_subtotal").cast("double") * F.lit(TAX_RATE) + F.lit(0.5))

    def amount(in_cents: Column) -> Column:
        return in_cents.cast("double") / F.lit(100.0)

    return grouped.withColumn("_tax", tax).select(
        "order_id",
        "line_count",
        amount(F.col("_subtotal")).alias("subtotal"),
        amount(F.col("_tax")).alias("tax"),
        amount(F.col("_shipping")).alias("shipping_cost"),
        amount(F.col("_subtotal") + F.col("_tax") + F.col("_shipping")).alias("total_amount"),
    )


def capped_cost(products: DataFrame) -> DataFrame:
    """Cost no higher than the given share of the price."""
    return products.withColumn("cost", F.least(F.col("cost"), F.col("price") * F.lit(COST_CAP)))
