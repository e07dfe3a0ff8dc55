"""Bucketed merges and timelines against the plain forms, and the plans they get."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from marketlane import scratch
from marketlane.operators import keyed, timeline, upsert

DAY = dt.datetime(2020, 1, 1)


@pytest.fixture(scope="module")
def pair(spark):
    target = spark.createDataFrame(
        [(1, "a", 1.0, "t"), (2, "b", 2.0, "t"), (3, None, None, "t"), (None, "x", 0.0, "t")], "id INT, name STRING, v DOUBLE, by STRING"
    )
    source = spark.createDataFrame(
        [(2, "B", None, "s"), (3, "C", 3.5, "s"), (9, "I", 9.0, "s"), (None, "n", 7.0, "s")], "id INT, name STRING, v DOUBLE, by STRING"
    )
    return keyed.store(target, ["id"], 4), source


@pytest.mark.parametrize(("update", "insert"), [(["name", "v"], None), (["name"], ["id", "name"]), ([], None)])
def test_equals_the_plain_merge(pair, rows, update, insert):
    target, source = pair
    got = rows(keyed.merge(target, source, update, insert))
    assert got == rows(upsert.upsert(target.rows, source, ["id"], update, insert)) and len(got) == 6


def test_only_newer_rows_update(pair, rows):
    target, source = pair
    got = {r[0]: r[1:] for r in rows(keyed.merge(target, source, ["name", "v"], newer_by="v"))}
    assert got[2] == ("b", 2.0, "t") and got[3] == ("C", 3.5, "t") and got[9] == ("I", 9.0, "s")


def test_duplicate_source_key_is_refused(pair):
    target, source = pair
    with pytest.raises(upsert.DuplicateKeys):
        keyed.merge(target, source.union(source), ["name"])


def exchanges(df):
    """What each exchange of the plan as first made moves."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((\w+)#", plan)


def test_stored_side_is_not_shuffled(pair, spark):
    target, source = pair
    for partitions in ("2", "64"):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            plan = keyed.merge(target, source, ["name"])
            assert exchanges(plan) == ["_new_id"]
            assert plan._jdf.queryExecution().executedPlan().toString().count("SortMergeJoin") == 1
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)


def test_merged_table_is_bucketed_again(pair, rows):
    target, source = pair
    once = keyed.merged(target, source.where("id IS NOT NULL"), ["name", "v"])
    assert rows(once.rows) == rows(keyed.merge(target, source.where("id IS NOT NULL"), ["name", "v"]))
    again = keyed.merge(once, source.where("id IS NOT NULL"), ["name"])
    assert exchanges(again) == ["_new_id"] and rows(again) == rows(once.rows)
    files = once.rows.select(F.input_file_name()).distinct().count()
    assert files <= once.buckets


def test_states_of_a_timeline(spark, rows):
    """Every state as of each moment and number, against states kept in a dict."""
    rng = random.Random(4)
    state = {k: (k, "x", float(k)) for k in range(20)}
    line = timeline.start(spark.createDataFrame(list(state.values()), "id INT, a STRING, v DOUBLE"), ["id"], DAY, 4)
    seen = [dict(state)]
    for step in range(1, 6):
        picked = rng.sample(range(30), 8)
        changes = [(k, f"s{step}", float(k * step), rng.choice("UUD")) for k in picked]
        held = scratch.durable(spark.createDataFrame(changes, "id INT, a STRING, v DOUBLE, _op STRING"), "changes")
        line = timeline.record(line, held, DAY + dt.timedelta(days=step))
        for k, a, v, op in changes:
            if op == "D":
                state.pop(k, None)
            else:
                state[k] = (k, a, v)
        seen.append(dict(state))
    for number, want in enumerate(seen, 1):
        moment = DAY + dt.timedelta(days=number - 1, hours=3)
        assert rows(timeline.as_of(line, number)) == rows(timeline.as_of(line, moment)) == sorted(want.values())
    assert timeline.as_of(line, DAY - dt.timedelta(days=1)).count() == 0
    report = timeline.compare(line, {"before": 0, "first": 1, "last": 6}, "v", "n", "total").collect()
    assert [tuple(r) for r in report] == [
        ("before", 0, None), ("first", 20, 190.0), ("last", len(state), sum(v for *_, v in state.values())),
    ]
    with pytest.raises(ValueError):
        timeline.record(line, held, DAY)


def test_present_is_read_alike_after_many_changes(spark):
    """The plan of the present does not grow with the number of changes; an older state skips rows that ended before it."""
    base = spark.range(100).select(F.col("id"), F.lit("x").alias("a"))
    line = timeline.start(base, ["id"], DAY, 2)

    def scans(df):
        return df._jdf.queryExecution().executedPlan().toString().count("FileScan")

    for step in range(1, 12):
        one = scratch.durable(spark.range(step, step + 1).select(F.col("id"), F.lit(f"s{step}").alias("a")), "change")
        line = timeline.record(line, one, DAY + dt.timedelta(days=step))
        assert scans(timeline.as_of(line, step + 1)) == 1 and scans(timeline.as_of(line, 1)) == 2
    old = timeline.as_of(line, 9)
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(to_no" in plan or "PartitionFilters: [isnull(to_no" in plan or "to_no" in plan.split("PartitionFilters")[1]
    assert {r["id"]: r["a"] for r in old.collect()}[9] == "x"


def test_a_timeline_deals_its_rows_once(spark, monkeypatch):
    """Keys are checked where the rows lie; the first load is shuffled to its buckets and nowhere else."""
    checked = []
    monkeypatch.setattr(timeline, "require_unique", lambda source, keys: checked.append(source.groupBy(*keys).count()))
    timeline.start(spark.range(100).select("id", F.lit(1).alias("v")), ["id"], DAY, 4)
    assert len(checked) == 1 and "Exchange" not in checked[0]._jdf.queryExecution().executedPlan().toString()


def test_a_timeline_refuses_a_key_twice(spark):
    with pytest.raises(upsert.DuplicateKeys):
        timeline.start(spark.createDataFrame([(1, "a"), (1, "b")], "id INT, v STRING"), ["id"], DAY, 2)


def test_loads_are_split_from_one_pass(spark, folder, rows):
    from marketlane.registry import states
    from marketlane.sources import adapters

    orders = adapters.orders(spark, folder).withColumn("ingested_at", F.when(F.col("quantity") != 2, F.col("ingested_at")))
    base, delta = states.stored_loads(orders)
    assert rows(base) == rows(states.first_load(orders)) and rows(delta) == rows(states.second_load(orders))
    for load in (base, delta):
        assert "Join" not in load._jdf.queryExecution().executedPlan().toString()
    held = states.States(spark, folder)
    assert "versions" not in vars(held) and held.line.number == 2 and "versions" not in vars(held)
    assert held.main > held.load and "versions" in vars(held)


def test_states_refuse_a_key_twice(spark, folder, monkeypatch):
    from marketlane.registry import states

    orders = states.adapters.orders(spark, folder)
    monkeypatch.setattr(states.adapters, "orders", lambda *_: orders.unionByName(orders))
    with pytest.raises(upsert.DuplicateKeys):
        states.States(spark, folder)
