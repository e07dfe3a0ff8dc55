"""Figures for a quick look at the business."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlane.functions.money import steps
from marketlane.plans.gold import valid_rows

CHURN_BAR = 0.5
# Names of the figures as the report shows them.
REVENUE = "Revenue MTD"
AT_RISK = "Clients à risque churn (>0.5)"
REORDER = "Produits à réapprovisionner"


def quick_view(silver: DataFrame, customers: DataFrame, products: DataFrame, as_of: dt.date) -> DataFrame:
    """Revenue of the month so far, customers at risk, products to reorder, each as text.

    The year and month are constants, so a table partitioned by them is read
    for that month only. Without orders in the month the revenue is NULL.
    """
    month = valid_rows(silver).where(
        (F.col("order_year") == as_of.year) & (F.col("order_month") == as_of.month)
    )
    revenue = (F.sum(steps("total_amount")).cast("decimal(30,0)") / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(20,2)")
    rows = F.count(F.lit(1)).cast("string")
    return (
        month.agg(F.lit(REVENUE).alias("metric"), revenue.cast("string").alias("value"))
        .unionByName(
            customers.where(F.col("churn_risk_score") > CHURN_BAR).agg(
                F.lit(AT_RISK).alias("metric"), rows.alias("value")
            )
        )
        .unionByName(
            products.where(F.col("reorder_recommended")).agg(F.lit(REORDER).alias("metric"), rows.alias("value"))
        )
    )
