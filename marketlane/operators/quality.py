"""Checks on raw tables and reports on the cleaned ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The statuses an order may have.
KNOWN_STATUSES = ("completed", "pending", "cancelled")


def order_checks() -> dict[str, Column]:
    """Check name -> condition every row must meet."""
    return {
        "no_null_order_id": F.col("order_id").isNotNull(),
        "no_null_customer_id": F.col("customer_id").isNotNull(),
        "positive_amounts": F.col("total_amount") > 0,
        "valid_quantities": F.col("quantity") > 0,
        "valid_status": F.col("status").isin(*KNOWN_STATUSES),
    }


def check_rows(df: DataFrame, table: str, checks: dict[str, Column]) -> DataFrame:
    """One row per check: passed, failed rows. A NULL outcome fails; an empty table passes.

    All checks share one pass over the table. The last row, ``all_passed``,
    sums them up. A failed check is reported, never raised.
    """
    broken = [
        F.count(F.when(~F.coalesce(condition, F.lit(False)), F.lit(1))).alias(name)
        for name, condition in checks.items()
    ]
    counted = df.agg(*broken)
    overall = reduce(lambda a, b: a + b, [F.col(name) for name in checks])
    rows = [
        F.struct(F.lit(name).alias("check_name"), F.col(name).alias("failed_rows")) for name in checks
    ] + [F.struct(F.lit("all_passed").alias("check_name"), overall.alias("failed_rows"))]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select(
        F.lit(table).alias("table_name"),
        "r.check_name",
        (F.col("r.failed_rows") == 0).alias("passed"),
        "r.failed_rows",
    )


def flag_distribution(silver: DataFrame) -> DataFrame:
    """Rows and percent per quality flag, most frequent first."""
    counted = silver.groupBy("data_quality_flag").agg(F.count(F.lit(1)).alias("records"))
    total = counted.agg(F.sum("records")).scalar()
    # Hundredths of a percent are cut at the half with whole-number arithmetic, so no rounding mode is involved.
    hundredths = F.floor(F.col("records").cast("double") * 10000.0 / total + 0.5)
    return counted.select(
        "data_quality_flag", "records", (hundredths.cast("double") / 100.0).alias("pct")
    ).orderBy(F.col("records").desc(), "data_quality_flag")


def _stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def freshness(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and newest arrival of each table."""
    return _stack(
        [
            df.agg(
                F.lit(name).alias("table_name"),
                F.count(F.lit(1)).alias("row_count"),
                F.max("ingested_at").alias("last_ingested"),
            )
            for name, df in tables.items()
        ]
    )


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return _stack(
        [
            df.agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("row_count"))
            for name, df in tables.items()
        ]
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
