"""Joins and aggregations where one key holds a third of the rows or more."""

import pytest
from pyspark.sql import functions as F

from marketlane import scratch
from marketlane.operators import joins
from marketlane.operators.aggregate import with_distinct_counts
from marketlane.plans import gold


@pytest.fixture(scope="module")
def hot(spark):
    """9,000 rows: a third of key H, a ninth without a key, the rest of 500 keys."""
    key = (
        F.when(F.col("id") % 3 == 0, F.lit("H"))
        .when(F.col("id") % 9 == 1, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("k"), (F.col("id") % 500).cast("string")))
    )
    fact = scratch.durable(spark.range(9000).select(F.col("id").cast("string").alias("id"), key.alias("key")), "fact")
    names = spark.range(400).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    lookup = names.union(spark.createDataFrame([("H",)], "key STRING")).withColumn("name", F.upper("key"))
    return fact, scratch.durable(lookup, "lookup")


def counts_of(fact):
    return fact.groupBy("key").agg(F.count(F.lit(1)).alias("rows"))


@pytest.fixture(autouse=True)
def small_pieces(monkeypatch):
    monkeypatch.setattr(joins, "ROWS_PER_PIECE", 100)


def test_pieces_keep_their_size_as_the_table_grows(spark):
    for rows in (5_000, 20_000):
        fact = spark.range(rows).select(
            F.when(F.col("id") % 10 < 4, "H").when(F.col("id") % 10 < 7, F.lit(None)).otherwise(F.col("id").cast("string")).alias("key")
        )
        found = joins.hot_keys(counts_of(fact), "key").collect()
        assert [(r["key"], r["_fan"]) for r in found] == [("H", rows * 4 // 10 // 100)]


def test_list_of_hot_keys_is_bounded(hot, monkeypatch):
    monkeypatch.setattr(joins, "ROWS_PER_PIECE", 1)
    monkeypatch.setattr(joins, "MOST_SPLIT", 9)
    found = joins.hot_keys(counts_of(hot[0]), "key").collect()
    assert [(r["key"], r["_fan"]) for r in found] == [("H", 3)]


@pytest.mark.parametrize("broadcast_rows", [None, 0])
def test_lookup_join_equals_plain_join(hot, broadcast_rows):
    fact, lookup = hot
    got = joins.lookup_join(fact, lookup, "key", "id", broadcast_rows).select("id", "key", "name")
    want = fact.join(lookup, "key", "left").select("id", "key", "name")
    assert got.count() == 9000
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_salted_rows_spread_over_partitions(spark, hot):
    fact, lookup = hot
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = scratch.durable(joins.hot_keys(counts_of(fact), "key"), "hot")
        joined = joins.salted_join(fact, lookup, "key", found, "id")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        plain = fact.join(lookup, "key", "left")
        plain_sizes = [r["count"] for r in plain.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == sum(plain_sizes) == 9000
    assert max(plain_sizes) >= 3000
    assert max(sizes) < 2000


@pytest.mark.parametrize("broadcast_rows", [None, 0])
def test_unmatched_dimension_rows_stay(hot, broadcast_rows):
    fact, lookup = hot
    dim = lookup.unionByName(lookup.sparkSession.createDataFrame([("alone", "ALONE")], "key STRING, name STRING"))
    got = joins.matches_or_alone(dim, fact, "key", "id", broadcast_rows).select("key", "name", "id")
    want = dim.join(fact, "key", "left").select("key", "name", "id")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_wide_rows_are_not_small(hot, monkeypatch):
    lookup = hot[1]
    assert joins.is_small(lookup) and not joins.is_small(lookup, 400) and joins.is_small(lookup, 401)
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 100_000)
    assert joins.is_small(lookup)
    assert not joins.is_small(lookup.withColumn("more", F.sequence(F.lit(1), F.lit(200))))


def test_insert_absent_keeps_first(spark, rows):
    have = spark.createDataFrame([("a", 1), ("b", 2)], "k STRING, v INT")
    more = spark.createDataFrame([("b", 9), ("c", 3), ("c", 3)], "k STRING, v INT")
    assert rows(joins.insert_absent(have, more, ["k"])) == [("a", 1), ("b", 2), ("c", 3)]


def test_distinct_counts_apart_from_measures(hot):
    fact = hot[0]
    got = with_distinct_counts(fact, ["key"], {"n": F.count(F.lit(1))}, {"ids": "id"})
    want = fact.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"))
    assert got.count() == want.count()
    assert got.select("key", "n", "ids").exceptAll(want).isEmpty()


def test_favourites_of_a_hot_key(spark):
    data = [("h", "x", None)] * 3 + [("h", "y", "web")] * 3 + [("h", None, None)] + [("c", None, "pos")]
    df = spark.createDataFrame(data, "k STRING, a STRING, b STRING")
    got = {r["k"]: (r["a1"], r["b1"]) for r in gold.favourites(df, "k", {"a1": "a", "b1": "b"}).collect()}
    assert got == {"h": ("x", None), "c": (None, "pos")}


def test_share_of_total(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k STRING, n BIGINT")
    got = {r["k"]: r["s"] for r in df.withColumn("s", joins.share_of_total(df, "n")).collect()}
    assert got == {"a": 25.0, "b": 75.0}
