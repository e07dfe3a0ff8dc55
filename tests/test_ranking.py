"""Ranks and tiles over many slices against a plain sort."""

import random

import pytest
from pyspark.sql import functions as F

from marketlane.operators import ranking


def brute(data, group_of, value_of, descending):
    """(row number, rank) per key within its group; NULL values last."""
    out = {}
    for g in {group_of(r) for r in data}:
        members = [r for r in data if group_of(r) == g]

        def place(r):
            v = value_of(r)
            return (v is None, 0 if v is None else (-v if descending else v))

        members.sort(key=lambda r: (place(r), r[0]))
        for i, r in enumerate(members, 1):
            ahead = sum(place(o) < place(r) for o in members)
            out[r[0]] = (i, ahead + 1)
    return out


def tiles(n, k):
    small, larger = divmod(n, k)
    return [t + 1 for t in range(k) for _ in range(small + (t < larger))]


@pytest.mark.parametrize("rows_per_slice", [3, 40, None])
@pytest.mark.parametrize("descending", [True, False])
def test_positions_with_a_hot_value_and_a_hot_group(spark, rows_per_slice, descending):
    rng = random.Random(7)
    data = []
    for i in range(300):
        group = "hot" if i % 3 else rng.choice(["a", "b", None])
        value = 5.0 if rng.random() < 0.5 else rng.choice([None, *map(float, range(10))])
        data.append((f"k{i:04d}", group, value))
    df = spark.createDataFrame(data, "k STRING, g STRING, v DOUBLE")
    grouped = ranking.positions(df, ["k"], [("v", descending)], ["g"], rows_per_slice)
    got = {r["k"]: (r["row_number"], r["rank"]) for r in grouped.collect()}
    assert got == brute(data, lambda r: r[1], lambda r: r[2], descending)
    whole = ranking.positions(df, ["k"], [("v", descending)], None, rows_per_slice)
    got = {r["k"]: (r["row_number"], r["rank"]) for r in whole.collect()}
    assert got == brute(data, lambda r: 0, lambda r: r[2], descending)


def test_all_values_equal(spark):
    df = spark.range(50).select(F.format_string("k%03d", "id").alias("k"), F.lit(1.0).alias("v"))
    placed = ranking.positions(df, ["k"], [("v", True)], None, 5)
    assert {r["rank"] for r in placed.collect()} == {1}
    assert sorted(r["row_number"] for r in placed.collect()) == list(range(1, 51))


@pytest.mark.parametrize("n, k", [(7, 5), (3, 5), (5, 5), (23, 4), (0, 5)])
def test_tile_sizes(spark, n, k):
    df = spark.range(1, n + 1).select(F.col("id").alias("row_number"))
    got = [r[0] for r in df.orderBy("row_number").select(ranking.ntile("row_number", n, k)).collect()]
    assert got == tiles(n, k)[:n]


@pytest.mark.parametrize("rows_per_slice", [7, None])
@pytest.mark.parametrize("broadcast_rows", [0, None])
def test_scales_by_counted_values(spark, rows_per_slice, broadcast_rows):
    data = [(f"c{i}", "x" if i < 20 else "y", float(i % 4), i) for i in range(30)]
    df = spark.createDataFrame(data, "c STRING, seg STRING, spent DOUBLE, orders INT")
    scored = ranking.score_scales(
        df,
        ["c"],
        scales={"spent": (None, "spent", True), "orders": (None, "orders", False), "seg": ("seg", "spent", True)},
        tiles={"spent_tile": ("spent", 5), "orders_tile": ("orders", 5)},
        ranks={"all_rank": "spent", "seg_rank": "seg"},
        rows_per_slice=rows_per_slice,
        broadcast_rows=broadcast_rows,
    )
    assert scored.count() == 30
    got = {r["c"]: r for r in scored.collect()}
    spent = brute(data, lambda r: 0, lambda r: r[2], True)
    orders = brute(data, lambda r: 0, lambda r: r[3], False)
    seg = brute(data, lambda r: r[1], lambda r: r[2], True)
    for key, row in got.items():
        assert row["spent_tile"] == tiles(30, 5)[spent[key][0] - 1]
        assert row["orders_tile"] == tiles(30, 5)[orders[key][0] - 1]
        assert (row["all_rank"], row["seg_rank"]) == (spent[key][1], seg[key][1])


@pytest.mark.parametrize("rows_per_slice", [5, None])
@pytest.mark.parametrize("broadcast_rows", [0, None])
@pytest.mark.parametrize("size", [0, 3, 200])
def test_tiles_of_ties_nulls_and_odd_values(spark, size, rows_per_slice, broadcast_rows):
    """Half of the rows tie on zero, of either sign; some have no value, no number or no part."""
    rng = random.Random(size)
    odd = [0.0, -0.0, 0.0, 0.0, None, float("nan"), 1.0, 2.0, -3.5, 7.25]
    data = [(i % 2, f"k{i:03d}" if i != 5 else None, rng.choice(["x", "x", None, "y"]), rng.choice(odd)) for i in range(size)]
    df = spark.createDataFrame(data, "a INT, b STRING, part STRING, v DOUBLE")
    scored = ranking.score_scales(
        df,
        ["a", "b"],
        scales={"up": (None, "v", False), "down": (None, "v", True), "in": ("part", "v", False)},
        tiles={"three": ("up", 3), "five": ("up", 5), "seven": ("down", 7)},
        ranks={"all_rank": "up", "part_rank": "in"},
        rows_per_slice=rows_per_slice,
        broadcast_rows=broadcast_rows,
    )
    got = {(r["a"], r["b"]): r for r in scored.collect()}
    assert len(got) == size

    def place(v, descending=False):
        if v is None:
            return (2, 0)
        return (1, 0) if v != v else (0, (-v if descending else v) + 0.0)

    def key(r):
        return (r[0], r[1] is None, r[1] or "")

    up = sorted(data, key=lambda r: (place(r[3]), key(r)))
    down = sorted(data, key=lambda r: (place(r[3], True), key(r)))
    for i, r in enumerate(up):
        mine = got[r[0], r[1]]
        assert (mine["three"], mine["five"]) == (tiles(size, 3)[i], tiles(size, 5)[i])
        assert mine["all_rank"] == 1 + sum(place(o[3]) < place(r[3]) for o in data)
        assert mine["part_rank"] == 1 + sum(place(o[3]) < place(r[3]) for o in data if o[2] == r[2])
    for i, r in enumerate(down):
        assert got[r[0], r[1]]["seven"] == tiles(size, 7)[i]


def test_scales_do_not_sort_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    scored = ranking.score_scales(df, ["k"], {"v": (None, "v", True)}, ranks={"place": "v"})
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
