"""Column lists of the raw, cleaned and reporting tables.

Each is a DDL string, which ``spark.read.schema`` and ``createTable`` accept.
"""

from __future__ import annotations

from pyspark.sql import types as T

BRONZE_CUSTOMERS = """
customer_id STRING, email STRING, first_name STRING, last_name STRING, city STRING, state STRING,
registration_date DATE, customer_segment STRING, ingested_at TIMESTAMP_NTZ"""

BRONZE_PRODUCTS = """
product_id STRING, product_name STRING, category STRING, price DOUBLE, stock_quantity INT,
ingested_at TIMESTAMP_NTZ"""

BRONZE_ORDERS = """
order_id STRING, customer_id STRING, order_date DATE, product_id STRING, quantity INT, status STRING,
payment_method STRING, total_amount DOUBLE, ingested_at TIMESTAMP_NTZ, order_source STRING"""

SILVER_ORDERS = """
order_id STRING, customer_id STRING, product_id STRING,
order_date DATE, order_year INT, order_month INT, order_quarter INT, day_of_week INT, is_weekend BOOLEAN,
quantity INT, status STRING, payment_method STRING, order_source STRING, channel_category STRING,
unit_price DOUBLE, subtotal DOUBLE, discount_amount DOUBLE, tax_amount DOUBLE, shipping_cost DOUBLE,
total_amount DOUBLE, profit_margin_pct DOUBLE,
customer_name STRING, customer_email STRING, customer_segment STRING, customer_city STRING,
customer_state STRING, customer_lifetime_orders BIGINT,
product_name STRING, product_category STRING,
order_value_tier STRING, customer_value_tier STRING, is_first_order BOOLEAN, is_repeat_customer BOOLEAN,
data_quality_flag STRING, processed_at TIMESTAMP_NTZ"""

SILVER_PROFILES = """
customer_id STRING, customer_name STRING, customer_email STRING, customer_segment STRING,
customer_city STRING, customer_state STRING, registration_date DATE, first_order_date DATE,
last_order_date DATE, total_orders BIGINT, lifetime_value DOUBLE, avg_order_value DOUBLE,
customer_tier STRING, churn_risk_score DOUBLE, is_active BOOLEAN, updated_at TIMESTAMP_NTZ"""

GOLD_DAILY = """
sale_date DATE, sale_year INT, sale_month INT, total_orders BIGINT, total_items_sold BIGINT,
unique_customers BIGINT, new_customers BIGINT, repeat_customers BIGINT, total_revenue DOUBLE,
avg_order_value DOUBLE, max_order_value DOUBLE, completion_rate DOUBLE, avg_profit_margin DOUBLE,
total_discounts DOUBLE, weekend_order_pct DOUBLE, online_revenue DOUBLE, instore_revenue DOUBLE,
partner_revenue DOUBLE, credit_card_orders BIGINT, paypal_orders BIGINT, other_payment_orders BIGINT,
premium_revenue DOUBLE, standard_revenue DOUBLE, basic_revenue DOUBLE, calculated_at TIMESTAMP_NTZ"""

GOLD_CUSTOMERS = """
customer_id STRING, customer_name STRING, customer_email STRING, customer_segment STRING,
customer_tier STRING, customer_city STRING, customer_state STRING, registration_date DATE,
first_order_date DATE, last_order_date DATE, days_since_last_order INT, total_orders BIGINT,
lifetime_value DOUBLE, avg_order_value DOUBLE, favorite_category STRING, favorite_payment_method STRING,
favorite_channel STRING, recency_score INT, frequency_score INT, monetary_score INT, rfm_score DOUBLE,
churn_risk_score DOUBLE, lifetime_value_rank BIGINT, segment_rank BIGINT, last_updated TIMESTAMP_NTZ"""

GOLD_PRODUCTS = """
product_id STRING, product_name STRING, product_category STRING, total_orders BIGINT, units_sold BIGINT,
total_revenue DOUBLE, avg_selling_price DOUBLE, unique_customers BIGINT, revenue_last_30d DOUBLE,
revenue_prev_30d DOUBLE, revenue_growth_pct DOUBLE, performance_quadrant STRING, revenue_rank BIGINT,
category_rank BIGINT, current_stock INT, days_of_stock_left BIGINT, reorder_recommended BOOLEAN,
last_calculated TIMESTAMP_NTZ"""

# Table name -> (columns, partition columns).
TABLES: dict[str, tuple[str, tuple[str, ...]]] = {
    "bronze.customers": (BRONZE_CUSTOMERS, ()),
    "bronze.products": (BRONZE_PRODUCTS, ("category",)),
    "bronze.orders": (BRONZE_ORDERS, ("order_date",)),
    "silver.orders_enriched": (SILVER_ORDERS, ("order_year", "order_month")),
    "silver.customer_profiles": (SILVER_PROFILES, ("customer_segment",)),
    "gold.daily_sales_summary": (GOLD_DAILY, ("sale_year", "sale_month")),
    "gold.customer_360": (GOLD_CUSTOMERS, ("customer_segment",)),
    "gold.product_performance": (GOLD_PRODUCTS, ("product_category",)),
}


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(" ".join(ddl.split()))


def names(ddl: str) -> list[str]:
    return struct(ddl).fieldNames()
