"""Hand-written rows at the edges of each business rule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlane import schemas
from marketlane.functions import columns as C
from marketlane.functions import money
from marketlane.operators import quality
from marketlane.plans import gold, kpi, rollup, silver

NOW = dt.datetime(2024, 6, 30)
TODAY = dt.date(2024, 6, 30)
STAMP = dt.datetime(2024, 1, 1)


def values(spark, kind, items, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i INT, v {kind}")
    return [r[0] for r in df.orderBy("i").select(column(F.col("v"))).collect()]


def test_shipping_steps(spark):
    assert values(spark, "DOUBLE", [49.99, 50.0, 99.99, 100.0, None], C.shipping) == [10, 5, 5, 0, 0]


def test_order_tiers(spark):
    got = values(spark, "DOUBLE", [100.0, 100.01, 500.01, 1000.0, 1000.01], C.order_tier)
    assert got == ["Minimal Value", "Low Value", "Medium Value", "Medium Value", "High Value"]


def test_loyalty_tiers(spark):
    got = values(spark, "BIGINT", [1, 2, 4, 5, 9, 10], C.loyalty_tier)
    assert got == ["New", "Regular", "Regular", "Loyal", "Loyal", "VIP"]


def test_spend_tiers(spark):
    got = values(spark, "DOUBLE", [None, 500.0, 500.01, 2000.01, 5000.01], C.spend_tier)
    assert got == ["Low Value", "Low Value", "Medium Value", "High Value", "VIP"]


def test_churn_steps(spark):
    got = values(spark, "INT", [30, 31, 90, 91, 180, 181, None], C.churn_score)
    assert got == [0.1, 0.2, 0.2, 0.5, 0.5, 0.8, 0.1]


def test_channels(spark):
    got = values(spark, "STRING", ["Web", " mobile ", "APP", "store", "POS", "In-Store", None], C.channel)
    assert got == ["Online", "Online", "Online", "In-Store", "In-Store", "Partner", "Partner"]


def test_weekend(spark):
    days = [dt.date(2024, 1, 5), dt.date(2024, 1, 6), dt.date(2024, 1, 7), None]
    assert values(spark, "DATE", days, lambda d: C.calendar(d)["is_weekend"]) == [False, True, True, False]
    assert values(spark, "DATE", days, lambda d: C.calendar(d)["day_of_week"]) == [6, 7, 1, None]


def test_discount_never_negative_and_zero_without_price(spark):
    df = spark.createDataFrame([(10.0, 25.0), (30.0, 25.0), (None, 25.0)], "subtotal DOUBLE, total DOUBLE")
    got = [r[0] for r in df.select(C.discount(F.col("subtotal"), F.col("total"))).collect()]
    assert got == [0.0, 5.0, 0.0]


def test_flags_in_order(spark):
    df = spark.createDataFrame(
        [(-1.0, 0, False, False), (1.0, 0, False, False), (1.0, 1, False, False), (1.0, 1, True, False), (1.0, 1, True, True)],
        "t DOUBLE, q INT, p BOOLEAN, c BOOLEAN",
    )
    got = [r[0] for r in df.select(C.quality_flag(F.col("t"), F.col("q"), F.col("p"), F.col("c"))).collect()]
    assert got == ["INVALID_AMOUNT", "INVALID_QUANTITY", "MISSING_PRODUCT", "MISSING_CUSTOMER", "VALID"]


def test_stock_cover_and_reorder(spark):
    df = spark.createDataFrame([(10, 0), (10, 60), (14, 60), (13, 60), (None, 60)], "s INT, u BIGINT")
    stock, units = F.col("s"), F.col("u")
    got = [tuple(r) for r in df.select(gold.days_of_stock(stock, units), gold.reorder_due(stock, units)).collect()]
    assert got == [(None, False), (5, True), (7, False), (6, True), (None, False)]


def test_growth_and_quadrants(spark):
    df = spark.createDataFrame([(20.0, 10.0), (20.0, 19.0), (5.0, 1.0), (5.0, 5.0), (20.0, 0.0)], "r DOUBLE, b DOUBLE")
    r, b = F.col("r"), F.col("b")
    got = [tuple(x) for x in df.select(gold.quadrant(r, b, F.lit(10.0)), gold.growth_pct(r, b)).collect()]
    assert [g[0] for g in got] == ["Star", "Cash Cow", "Question Mark", "Dog", "Star"]
    assert got[0][1] == 100.0 and got[4][1] is None


@pytest.fixture(scope="module")
def shop(spark):
    """Three customers, two products and the orders the rules need."""

    def made(ddl, rows):
        return spark.createDataFrame(rows, schemas.struct(ddl))

    customers = made(
        schemas.BRONZE_CUSTOMERS,
        [
            ("C1", " A@X.com ", " Ann ", "Lee", "Rome", "RM", TODAY, "Premium", STAMP),
            ("C2", None, "Bo", "Ray", "Oslo", None, TODAY, "Basic", STAMP),
            ("C3", "c@x.com", "Cy", "Dee", "Bern", "BE", TODAY, "Basic", STAMP),
        ],
    )
    products = made(
        schemas.BRONZE_PRODUCTS, [("P1", "ring", "Toys", 100.0, 3, STAMP), ("P2", "bolt", "Toys", 10.0, 500, STAMP)]
    )

    def order(i, buyer, day, product, quantity, status, total, source="Web"):
        return (f"O{i}", buyer, day, product, quantity, status, "PayPal", total, STAMP, source)

    d = dt.date
    orders = made(
        schemas.BRONZE_ORDERS,
        [
            order(1, "C1", d(2024, 6, 1), "P1", 2, " completed", 150.0),
            order(2, "C1", d(2024, 6, 1), "P2", 1, "pending", 10.0),
            order(3, "C1", d(2024, 6, 20), "P1", 1, "Completed", 600.0, None),
            order(4, "C1", d(2024, 5, 1), "P1", 1, " CANCELLED ", 90.0),
            order(5, "C2", d(2024, 1, 1), "P2", 1, "completed", 20.0),
            order(6, None, d(2024, 6, 2), "P1", 1, "completed", 70.0),
            order(7, "GONE", d(2024, 6, 2), "P1", 1, "completed", 70.0),
            order(8, "C1", d(2024, 6, 3), None, 1, "completed", 70.0),
            order(9, "C1", d(2024, 6, 3), "P1", 0, "completed", 70.0),
            order(10, "C1", d(2024, 4, 1), "P1", 1, "completed", -5.0),
            order(11, "C1", d(2024, 6, 4), "P1", 1, None, 70.0),
        ],
    )
    return orders, customers, products


@pytest.mark.parametrize("broadcast_rows", [None, 0])
def test_enriched_orders(shop, broadcast_rows):
    got = {r["order_id"]: r for r in silver.enrich_orders(*shop, NOW, broadcast_rows).collect()}
    assert sorted(got) == ["O1", "O2", "O3", "O5", "O6", "O7", "O8", "O9"]  # no cancelled, unknown status or bad amount
    # The refunded order of April is the buyer's first: history counts it although it is not kept.
    assert not got["O1"]["is_first_order"]
    assert got["O1"]["customer_lifetime_orders"] == 6 and got["O1"]["customer_value_tier"] == "Loyal"
    assert got["O1"]["discount_amount"] == 50.0 and got["O3"]["discount_amount"] == 0.0
    assert got["O1"]["customer_name"] == "Ann Lee" and got["O1"]["customer_email"] == "a@x.com"
    assert got["O5"]["is_first_order"] and not got["O5"]["is_repeat_customer"]
    assert got["O6"]["customer_lifetime_orders"] == 1 and not got["O6"]["is_first_order"]
    assert got["O8"]["unit_price"] is None and got["O8"]["discount_amount"] == 0.0
    flags = {i: r["data_quality_flag"] for i, r in got.items()}
    assert flags["O9"] == "INVALID_QUANTITY" and flags["O8"] == "MISSING_PRODUCT"
    assert flags["O6"] == flags["O7"] == "MISSING_CUSTOMER" and flags["O1"] == "VALID"


def test_same_day_first_orders(spark, shop):
    orders, customers, products = shop
    kept = orders.where("total_amount > 0")
    got = {r["order_id"]: r["is_first_order"] for r in silver.enrich_orders(kept, customers, products, NOW).collect()}
    assert got["O1"] and got["O2"] and not got["O3"]


def test_profiles(shop):
    orders, customers, _ = shop
    got = {r["customer_id"]: r for r in silver.customer_profiles(customers, orders, TODAY, NOW).collect()}
    assert sorted(got) == ["C1", "C3"]  # C2 has no email
    assert got["C1"]["total_orders"] == 5 and got["C1"]["lifetime_value"] == 900.0
    assert got["C3"]["total_orders"] == 0 and got["C3"]["lifetime_value"] is None
    assert got["C3"]["customer_tier"] == "Low Value" and got["C3"]["churn_risk_score"] == 0.1


def test_checks_on_empty_table_pass(spark, rows):
    empty = spark.createDataFrame([], schemas.struct(schemas.BRONZE_ORDERS))
    checked = quality.check_rows(empty, "orders", quality.order_checks())
    assert len(rows(checked)) == 6 and all(r["passed"] for r in checked.collect())


def test_checks_report_failures(shop):
    checked = quality.check_rows(shop[0], "orders", quality.order_checks())
    got = {r["check_name"]: r["failed_rows"] for r in checked.collect()}
    assert got == {
        "no_null_order_id": 0, "no_null_customer_id": 1, "positive_amounts": 1, "valid_quantities": 1,
        "valid_status": 4, "all_passed": 7,
    }


def test_quick_view_without_orders_this_month(spark, shop):
    from marketlane import scratch

    enriched = scratch.durable(silver.enrich_orders(*shop, NOW), "t")
    customers = gold.customer_360(enriched, shop[1], TODAY, NOW)
    products = gold.product_performance(enriched, shop[2], TODAY, NOW)
    later = kpi.quick_view(enriched, customers, products, dt.date(2030, 1, 1))
    assert later.where(F.col("metric") == kpi.REVENUE).first()["value"] is None


def test_line_rounding(spark):
    lines = spark.createDataFrame(
        [("A", "P", 3, 9.99, 15), ("A", "P", 1, 0.05, 10), ("B", "P", 1, 100.0, 0)],
        "order_id STRING, product_id STRING, quantity INT, unit_price DOUBLE, discount_pct INT",
    )
    got = {r["order_id"]: r for r in rollup.order_totals(lines).collect()}
    # 29.97 less 4.50 is 25.47; 0.05 less 0.01 is 0.04
    assert got["A"]["subtotal"] == 25.51 and got["A"]["tax"] == 2.04 and got["A"]["total_amount"] == 27.55
    assert got["B"]["total_amount"] == 108.0


def test_cost_cap(spark):
    df = spark.createDataFrame([(90.0, 100.0), (50.0, 100.0)], "cost DOUBLE, price DOUBLE")
    assert [r["cost"] for r in rollup.capped_cost(df).collect()] == [70.0, 50.0]


def test_amounts_below_a_cent_and_sums_past_int(spark):
    small = spark.range(1000).select(F.lit(0.004).alias("v"))
    assert small.agg(money.money_sum("v")).first()[0] == 4.0
    assert small.agg(money.money_avg("v")).first()[0] == 0.004
    large = spark.range(3).select(F.lit(2_000_000_000.0).alias("v"), F.lit(2_000_000_000).alias("n"))
    assert large.agg(money.money_sum("v")).first()[0] == 6e9
    assert large.agg(money.count_where(F.col("v") > 0)).first()[0] == 3
