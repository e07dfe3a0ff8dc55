import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlane import scratch
from marketlane.operators import daily
from marketlane.plans import gold, gold_refresh
from marketlane.registry.base import AS_OF, NOW
from marketlane.registry.products import stored_silver
from marketlane.sources import adapters

DDL = "id INT, day DATE, who STRING, n INT"
D = [dt.date(2001, 1, 30), dt.date(2001, 1, 31), dt.date(2001, 2, 1), None]
FIRST = [(1, D[0], "a", 5), (2, D[0], "b", None), (3, D[1], "a", 7), (4, D[2], None, 1), (5, None, "a", 2), (None, D[1], "c", 3)]


@pytest.fixture(params=[daily.DAY, daily.MONTH])
def table(spark, request):
    return daily.store(spark.createDataFrame(FIRST, DDL), "day", "t", request.param)


def _files(table):
    return {p for p in table.rows.inputFiles()}


def test_rows_are_kept_by_period_and_read_by_it(spark, table, rows):
    assert rows(table.rows) == rows(spark.createDataFrame(FIRST, DDL))
    assert [r["id"] for r in table.within([None]).collect()] == [5]
    periods = [D[2]]
    assert [r["id"] for r in table.within(periods).collect()] == [4]
    plan = table.within(periods)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" + daily.PERIOD in plan or f"({daily.PERIOD}#" in plan.split("PartitionFilters")[1]
    assert table.within([]).count() == 0


def test_upsert_moves_adds_and_empties_periods(spark, table, rows):
    arrived = [(4, D[0], "z", 9), (5, D[0], "a", 2), (9, D[1], "n", 1), (None, D[1], "d", 4)]
    touched = daily.upsert(table, spark.createDataFrame(arrived, DDL), ["id"])
    left = [r for r in FIRST if r[0] is None or r[0] not in {4, 5, 9}]
    assert rows(table.rows) == rows(spark.createDataFrame(left + arrived, DDL))
    assert None in touched and table.within([None, D[2]]).count() == 0
    assert daily.upsert(table, spark.createDataFrame([], DDL), ["id"]) == []
    assert rows(table.rows) == rows(spark.createDataFrame(left + arrived, DDL))


def test_other_periods_are_not_rewritten(spark, table):
    before = _files(table)
    daily.upsert(table, spark.createDataFrame([(4, D[2], "z", 9)], DDL), ["id"])
    after = _files(table)
    assert {p for p in before if "2001-02-01" not in p} == {p for p in after if "2001-02-01" not in p}
    assert not {p for p in before if "2001-02-01" in p} & after


def test_partials_merge_to_the_totals(spark, table, rows):
    sums = daily.Partial(("who",), {"s": F.col("n")}, {"lo": F.col("n")}, {"hi": F.col("n")})
    ids = daily.Partial(("who", "id"))
    stored = [daily.store(p.of(table.rows, "day"), "day", "p", table.per) for p in (sums, ids)]

    def check():
        got = stored[0].rows.groupBy("who").agg(F.sum("s").alias("s"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        got = daily.with_distinct(got, ["who"], {"ids": (stored[1].rows, "id")})
        want = table.rows.groupBy("who").agg(
            F.sum("n").alias("s"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.countDistinct("id").alias("ids")
        )
        assert rows(got) == rows(want)

    check()
    touched = daily.upsert(table, spark.createDataFrame([(3, D[2], "b", 8), (5, D[2], None, 1)], DDL), ["id"])
    for t, p in zip(stored, (sums, ids)):
        daily.refresh(t, p, table.within(touched), touched)
    check()


def test_one_day_refresh_equals_the_full_build(spark, folder, rows):
    """A day's orders change and one moves there: only its days are computed, and all reports equal those of a full build."""
    reads = list(dict.fromkeys([*gold.DAILY_READS, *gold.CUSTOMER_READS, *gold.PRODUCT_READS]))
    start, end = dt.date(2001, 6, 1), dt.date(2001, 7, 31)
    silver = scratch.durable(stored_silver(spark, folder, reads).where(F.col("order_date").between(start, end)), "few")
    made = gold_refresh.build(silver, NOW)
    busy = silver.groupBy("order_date").count().orderBy(F.desc("count"), "order_date").limit(2).collect()
    day, end = sorted(r["order_date"] for r in busy)
    moved = silver.where(F.col("order_date") == end).orderBy("order_id").limit(1).withColumn("order_date", F.lit(day))
    changed = silver.where(F.col("order_date") == day).withColumn("total_amount", F.col("total_amount") + 1000)
    arrived = scratch.durable(changed.unionByName(moved), "arrived")
    touched = gold_refresh.refresh(made, arrived, ["order_id"], NOW)
    assert touched == [day, end]
    full = scratch.durable(silver.join(arrived.select("order_id"), "order_id", "left_anti").unionByName(arrived), "full")
    customers, products = adapters.customers(spark, folder), adapters.products(spark, folder)
    pairs = [
        (made.silver.rows, full.select(made.silver.rows.columns)),
        (made.days.rows, gold.daily_sales(full, NOW)),
        (gold_refresh.customer_360(made, customers, AS_OF, NOW), gold.customer_360(full, customers, AS_OF, NOW)),
        (gold_refresh.product_performance(made, products, AS_OF, NOW), gold.product_performance(full, products, AS_OF, NOW)),
    ]
    for got, want in pairs:
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("per", [daily.DAY, daily.MONTH])
def test_partials_are_stored_with_one_shuffle(spark, rows, monkeypatch, per):
    """Groups and layout share it, periods with many rows are in pieces, and the rows are those of ``of``."""
    monkeypatch.setattr(daily, "ROWS_PER_PIECE", 10)
    data = [(i, None if i % 7 == 0 else D[i % 3], "ab"[i % 2] if i % 5 else None, i) for i in range(100)]
    table = daily.store(spark.createDataFrame(data, DDL), "day", "t", per)
    shuffles = []
    repartition = type(table.rows).repartition
    monkeypatch.setattr(type(table.rows), "repartition", lambda self, *by: shuffles.append(by) or repartition(self, *by))
    for p in (daily.Partial(("who",), {"s": F.col("n")}, {"lo": F.col("n")}, {"hi": F.col("n")}), daily.Partial(("who", "id"))):
        stored = daily.store_partial(p, table.rows, "day", "p", per)
        assert rows(stored.rows) == rows(p.of(table.rows, "day"))
        assert stored.rows.columns == p.of(table.rows, "day").columns
        files = stored.rows.select("_metadata.file_path").distinct().count()
        assert files >= len(daily.periods_of(stored.rows, "day", per))
    assert shuffles == [(daily.PERIOD, "_piece_")] * 2
    found = spark.createDataFrame(data, DDL)
    pieces = found.select("day", daily._pieces(found, daily.period_of(F.col("day"), per)).alias("n")).distinct().collect()
    assert all(r["n"] >= 2 for r in pieces)
