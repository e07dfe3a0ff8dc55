"""Rewrites along a space-filling curve: same rows, few files for a condition on any column."""

import random

from pyspark.sql import functions as F

from marketlane import scratch
from marketlane.operators import inspect, maintain


def bisected(cuts, value):
    return sum(c <= value for c in cuts)


def test_cells_by_bisection(spark):
    cuts = [1, 1, 2, 5, 5, 8, 9]
    rows = spark.range(-1, 12).select(F.col("id").cast("int").alias("v"))
    got = {r["v"]: r["cell"] for r in rows.select("v", maintain._cell(F.col("v"), cuts).alias("cell")).collect()}
    assert got == {v: bisected(cuts, v) for v in range(-1, 12)}


def test_place_takes_bits_in_turn(spark):
    df = spark.range(16).select(F.col("id"), (F.col("id") % 4).alias("x"), F.floor(F.col("id") / 4).alias("y"))
    placed = df.withColumn("place", maintain.curve_place(df, ["x", "y"], "id", 2)).collect()
    for r in placed:
        want = (r["x"] >> 1 & 1) << 3 | (r["y"] >> 1 & 1) << 2 | (r["x"] & 1) << 1 | (r["y"] & 1)
        assert r["place"] == want


def test_lookups_open_few_files(spark, rows):
    rng = random.Random(3)
    data = [(i, rng.randrange(7), rng.randrange(1, 13), f"c{rng.randrange(400):04d}") for i in range(20_000)]
    df = spark.createDataFrame(data, "k INT, year INT, month INT, buyer STRING").repartition(16)
    by = ["year", "month", "buyer"]
    laid = maintain.curve_rewrite(df, scratch.new_dir(spark, "curve"), by, "k", 64)
    assert rows(laid) == sorted(data)
    spans = scratch.durable(inspect.ranges(laid, by), "ranges")
    assert 48 <= spans.count() <= 64 and spans.agg(F.sum("record_count")).first()[0] == len(data)

    def opened(bounds):
        found = maintain.read_within(spark, spans, laid, bounds)
        assert maintain.read_within(spark, spans, laid, {"buyer": ("d", "e")}).count() == 0
        at = {"k": 0, "year": 1, "month": 2, "buyer": 3}
        want = sorted(r for r in data if all(lo <= r[at[c]] <= hi for c, (lo, hi) in bounds.items()))
        assert rows(found) == want
        return len(found.inputFiles())

    assert opened({"buyer": ("c0123", "c0123")}) <= 24
    assert opened({"month": (5, 5)}) <= 32
    assert opened({"year": (3, 3), "month": (5, 5), "buyer": ("c0123", "c0123")}) <= 4
    plain = maintain.sorted_rewrite(df, scratch.new_dir(spark, "sorted"), by, "k", 64)
    spans, laid = scratch.durable(inspect.ranges(plain, by), "ranges"), plain
    assert opened({"buyer": ("c0123", "c0123")}) == 64  # what a sorted rewrite opens


def test_empty_and_null_values(spark, rows):
    schema = "k INT, a INT, b STRING"
    empty = spark.createDataFrame([], schema)
    assert maintain.curve_rewrite(empty, scratch.new_dir(spark, "curve"), ["a", "b"], "k", 2).count() == 0
    data = [(1, None, None), (2, 5, None), (3, None, "x"), (4, 5, "x"), (4, 5, "x")]
    laid = maintain.curve_rewrite(spark.createDataFrame(data, schema), scratch.new_dir(spark, "curve"), ["a", "b"], "k", 2)
    assert laid.count() == 5 and len(rows(laid)) == 5
