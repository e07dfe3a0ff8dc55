"""Raw retail tables as views over the given star-schema files.

The views put in the dirt the cleaning steps must cope with: padded text,
unknown and missing customers, orders without a product, and bad amounts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOADED_AT = "TIMESTAMP_NTZ '1995-01-01 00:00:00'"

_SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
}


def raw(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One given table, with its columns declared so that no footer is read to plan."""
    return spark.read.schema(_SCHEMAS[table]).parquet(f"{folder}/{table}.parquet")


def _padded(key: str, prefix: str, width: int) -> str:
    """Zero-padded key text; longer keys keep all their digits (lpad alone would cut them)."""
    digits = f"CAST({key} AS STRING)"
    return (
        f"concat('{prefix}', CASE WHEN {key} < {10**width} THEN lpad({digits}, {width}, '0') ELSE {digits} END)"
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return raw(spark, folder, "part").selectExpr(
        f"{_padded('p_partkey', 'PROD-', 5)} AS product_id",
        "p_name AS product_name",
        "p_type AS category",
        "CAST(p_size * 20 AS DOUBLE) AS price",
        "CAST(p_partkey % 501 AS INT) AS stock_quantity",
        f"{LOADED_AT} AS ingested_at",
    )


def customers(spark: SparkSession, folder: str) -> DataFrame:
    nation = raw(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    # The nations are a fixed list of countries.
    return raw(spark, folder, "customer").join(F.broadcast(nation), "c_nationkey", "left").selectExpr(
        f"{_padded('c_custkey', 'CUST-', 6)} AS customer_id",
        "CASE WHEN c_custkey % 50 != 0 THEN concat(' ', c_name, '@Example.COM ') END AS email",
        "' Cust' AS first_name",
        "concat('N', CAST(c_custkey AS STRING), ' ') AS last_name",
        "concat('City', CAST(c_custkey % 40 AS STRING)) AS city",
        "CASE WHEN c_custkey % 29 != 0 THEN n_name END AS state",
        "DATE '1995-01-01' AS registration_date",
        """CASE c_mktsegment WHEN 'BUILDING' THEN 'Premium' WHEN 'MACHINERY' THEN 'Standard'
           ELSE 'Basic' END AS customer_segment""",
        f"{LOADED_AT} AS ingested_at",
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the lowest part of their lines as the product bought."""
    lead = raw(spark, folder, "lineitem").groupBy("l_orderkey").agg(F.min("l_partkey").alias("lead_part"))
    joined = raw(spark, folder, "orders").join(
        lead.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left"
    )
    return joined.selectExpr(
        f"{_padded('o_orderkey', 'ORD-', 8)} AS order_id",
        f"""CASE WHEN o_orderkey % 62 = 0 THEN NULL
            WHEN o_orderkey % 31 = 0 THEN {_padded('o_orderkey', 'GUEST-', 8)}
            ELSE {_padded('o_custkey', 'CUST-', 6)} END AS customer_id""",
        "CAST(o_orderdate AS DATE) AS order_date",
        f"{_padded('lead_part', 'PROD-', 5)} AS product_id",
        "CAST(CASE WHEN o_orderkey % 97 = 0 THEN 0 ELSE 1 + o_orderkey % 5 END AS INT) AS quantity",
        """CASE o_orderstatus WHEN 'F' THEN ' completed' WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS status""",
        """CASE o_orderpriority WHEN '1-URGENT' THEN 'Credit Card' WHEN '2-HIGH' THEN 'PayPal'
           ELSE 'Debit Card' END AS payment_method""",
        """CASE WHEN o_orderkey % 89 = 0 THEN -1D
           ELSE CAST(floor(o_totalprice / 2.5D) AS DOUBLE) / 100D END AS total_amount""",
        "o_orderdate AS ingested_at",
        """CASE o_orderkey % 6 WHEN 0 THEN 'Web' WHEN 1 THEN ' mobile ' WHEN 2 THEN 'POS'
           WHEN 3 THEN 'In-Store' WHEN 4 THEN 'Phone' END AS order_source""",
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with unit price in cents and discount percent, for the roll-up."""
    return raw(spark, folder, "lineitem").selectExpr(
        f"{_padded('l_orderkey', 'ORD-', 8)} AS order_id",
        f"{_padded('l_partkey', 'PROD-', 5)} AS product_id",
        "CAST(l_quantity AS INT) AS quantity",
        "CAST(floor(l_extendedprice / l_quantity * 100D) AS DOUBLE) / 100D AS unit_price",
        "CAST(floor(l_discount * 100D + 0.5D) AS INT) AS discount_pct",
    )
