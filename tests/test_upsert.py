import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlane.operators import upsert


@pytest.fixture(scope="module")
def pair(spark):
    target = spark.createDataFrame(
        [(1, "a", 1.0, "t"), (2, "b", 2.0, "t"), (3, None, None, "t")], "id INT, name STRING, v DOUBLE, by STRING"
    )
    source = spark.createDataFrame(
        [(2, "B", None, "s"), (3, "C", 3.5, "s"), (9, "I", 9.0, "s")], "id INT, name STRING, v DOUBLE, by STRING"
    )
    return target, source


@pytest.mark.parametrize("broadcast_rows", [None, 0])
def test_updates_listed_columns_and_inserts_whole_rows(pair, rows, broadcast_rows):
    got = rows(upsert.upsert(*pair, ["id"], ["name", "v"], broadcast_rows=broadcast_rows))
    assert got == [(1, "a", 1.0, "t"), (2, "B", None, "t"), (3, "C", 3.5, "t"), (9, "I", 9.0, "s")]


def test_inserts_only_listed_columns(pair, rows):
    got = rows(upsert.upsert(*pair, ["id"], ["name"], insert=["id", "name"]))
    assert got[-1] == (9, "I", None, None)


def test_second_run_changes_nothing(pair, rows):
    once = upsert.upsert(*pair, ["id"], ["name", "v"])
    twice = upsert.upsert(once, pair[1], ["id"], ["name", "v"])
    assert rows(once) == rows(twice)


@pytest.mark.parametrize("broadcast_rows", [None, 0])
def test_changed_rows_are_only_those_touched(pair, rows, broadcast_rows):
    got = rows(upsert.changed_rows(*pair, ["id"], ["name", "v"], broadcast_rows=broadcast_rows), "id")
    assert got == [(2,), (3,), (9,)]


def test_duplicate_source_key_is_refused(pair):
    target, source = pair
    with pytest.raises(upsert.DuplicateKeys):
        upsert.upsert(target, source.union(source), ["id"], ["name"])


def test_rows_without_key_are_inserted(pair, rows):
    target, _ = pair
    source = target.sparkSession.createDataFrame([(None, "n", 0.0, "s")], target.schema)
    assert len(rows(upsert.upsert(target, source, ["id"], ["name"]))) == 4


def test_high_water_mark_of_an_empty_table_is_the_epoch(spark):
    empty = spark.createDataFrame([], "at TIMESTAMP_NTZ")
    got = spark.range(1).select(upsert.high_water_mark(empty, "at").alias("m")).first()["m"]
    assert got == dt.datetime(1970, 1, 1)


def test_newest_per_key(spark, rows):
    df = spark.createDataFrame([("h", i) for i in range(100)] + [("c", None), ("c", 4)], "k STRING, v INT")
    newest = upsert.newest_per_key(df, ["k"], "v")
    assert rows(newest) == [("c", 4), ("h", 99)]
    # Each task keeps one row per key before the shuffle.
    assert newest._jdf.queryExecution().toString().count("WindowGroupLimit") >= 2


def test_mark_is_pushed_to_the_scan(spark, folder):
    from marketlane.sources import adapters

    orders = adapters.raw(spark, folder, "orders")
    mark = orders.where("o_orderkey < 0").agg(F.max("o_orderdate")).scalar()
    plan = orders.where(F.col("o_orderdate") > mark)._jdf.queryExecution().toString()
    assert "ScalarSubquery" in plan or "Subquery" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan
