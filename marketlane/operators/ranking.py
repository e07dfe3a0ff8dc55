"""Row numbers, ranks and tiles over a whole table without a one-task window.

``positions`` numbers every row: the rows are range-partitioned and sorted by
the full sort key, numbered where they lie, and written once. Every slice then
needs only the totals of the slices before it. The sort key ends in a unique
column, so a value or group that holds any share of the rows is cut into
several slices as well.

``score_scales`` needs no order of the rows: ranks and tiles follow from how
many rows have each value. Only rows that tie on a value in which a tile ends
are numbered by their keys.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlane import scratch
from marketlane.operators import joins

ROWS_PER_SLICE = 1_000_000
LEAST_SLICES = 4
# monotonically_increasing_id keeps the partition number above its low 33 bits.
_INDEX_BITS = 33


def _slices(rows: int, rows_per_slice: int | None) -> int:
    per_slice = ROWS_PER_SLICE if rows_per_slice is None else rows_per_slice
    return max(LEAST_SLICES, -(-rows // per_slice))


def _fits(rows: int, rows_per_slice: int | None) -> bool:
    """Whether so many rows are no more than a slice, which a window takes in one task."""
    return rows <= (ROWS_PER_SLICE if rows_per_slice is None else rows_per_slice)


def _order(name: str, descending: bool) -> Column:
    return F.col(name).desc_nulls_last() if descending else F.col(name).asc_nulls_last()


def _laid_out(df: DataFrame, sort: list[Column], slices: int) -> DataFrame:
    laid = (
        df.repartitionByRange(slices, *sort)
        .sortWithinPartitions(*sort)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    return (
        scratch.durable(laid, "ranked")
        .withColumn("_slice", F.shiftright("_at", _INDEX_BITS).cast("int"))
        .withColumn("_index", F.col("_at").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1)))
    )


def _few(edges: DataFrame, slices: int) -> DataFrame:
    """Broadcast rows of slices, unless there are too many."""
    return F.broadcast(edges) if slices <= joins.BROADCAST_ROWS else edges


def positions(
    df: DataFrame,
    keys: list[str],
    order: list[tuple[str, bool]],
    group: list[str] | None = None,
    rows_per_slice: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """``df`` with ``row_number`` and ``rank`` inside each ``group``.

    ``order`` lists (column, descending); ``keys`` are unique together and break
    ties in the row number. NULLs sort last. ``df`` is read several times, so pass a
    stored table, and its number of ``rows`` if known.
    """
    group = group or []
    value_sort = [_order(name, desc) for name, desc in order]
    group_sort = [_order(name, False) for name in group]
    key_sort = [_order(name, False) for name in keys]
    slices = _slices(df.count() if rows is None else rows, rows_per_slice)
    placed = _laid_out(df, [*group_sort, *value_sort, *key_sort], slices)

    in_slice = Window.partitionBy("_slice")
    placed = placed.withColumn(
        "_tie_start", F.rank().over(in_slice.orderBy(*group_sort, *value_sort))
    ).withColumn(
        "_group_start",
        F.rank().over(in_slice.orderBy(*group_sort)) if group else F.lit(1),
    )
    # A leading constant keeps the struct non-empty when there is no group.
    placed = placed.withColumn("_group", F.struct(F.lit(0).alias("g"), *group)).withColumn(
        "_tie", F.struct("_group", *[name for name, _ in order])
    )

    # One row per slice from here to the join.
    edges = placed.groupBy("_slice").agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min_by("_group", "_at").alias("_first_group"),
        F.max_by("_group", "_at").alias("_last_group"),
        F.min_by("_tie", "_at").alias("_first_tie"),
        F.max_by("_tie", "_at").alias("_last_tie"),
        F.max_by("_group_start", "_at").alias("_last_group_start"),
        F.max_by("_tie_start", "_at").alias("_last_tie_start"),
    )
    along = Window.orderBy("_slice")

    def carried(part: str) -> Column:
        """Rows in earlier slices that share this slice's first group or tie."""
        ending = F.sum(F.col("_rows") - F.col(f"_last_{part}_start") + 1).over(
            Window.partitionBy(f"_last_{part}").orderBy("_slice")
        )
        return ending

    edges = edges.withColumn("_group_run", carried("group")).withColumn("_tie_run", carried("tie"))
    for part in ("group", "tie"):
        continues = F.lag(f"_last_{part}").over(along).eqNullSafe(F.col(f"_first_{part}"))
        edges = edges.withColumn(
            f"_{part}_carry",
            F.when(continues, F.lag(f"_{part}_run").over(along)).otherwise(F.lit(0)),
        )
    edges = edges.select("_slice", "_first_group", "_first_tie", "_group_carry", "_tie_carry")

    joined = placed.join(_few(edges, slices), "_slice")
    before = F.when(F.col("_group").eqNullSafe(F.col("_first_group")), F.col("_group_carry")).otherwise(0)
    tied = F.when(F.col("_tie").eqNullSafe(F.col("_first_tie")), F.col("_tie_carry")).otherwise(0)
    return joined.select(
        *[F.col(c) for c in df.columns],
        (F.col("_index") + 2 - F.col("_group_start") + before).alias("row_number"),
        (F.col("_tie_start") - F.col("_group_start") + 1 + before - tied).alias("rank"),
    )


def ntile(row_number: str, rows: int, tiles: int) -> Column:
    """Tile of a row by its number among ``rows``; the first tiles take the remainder."""
    small, larger = divmod(rows, tiles)
    in_larger = larger * (small + 1)
    head = f"({row_number} - 1) div {small + 1} + 1"
    tail = f"{larger} + ({row_number} - {in_larger} - 1) div {max(small, 1)} + 1"
    return F.expr(f"CASE WHEN {row_number} <= {in_larger} THEN {head} ELSE {tail} END").cast("int")


def _ends(rows: int, tiles: int) -> list[int]:
    """Row numbers at which a tile ends and another begins."""
    small, larger = divmod(rows, tiles)
    ends = [k * small + min(k, larger) for k in range(1, tiles)]
    return sorted({e for e in ends if 0 < e < rows})


def _rows_before(values: DataFrame, rows_per_slice: int | None) -> DataFrame:
    """``values`` (scale, part, score, n) with ``before``: the rows of smaller scores in the same part.

    The values lie in slices by range, each with the running sum of its rows; a
    part that goes on into the next slice takes along what it had before.
    """
    number = values.count()
    if _fits(number, rows_per_slice):
        in_part = Window.partitionBy("scale", "part").orderBy(_order("score", False))
        upto = F.sum("n").over(in_part.rowsBetween(Window.unboundedPreceding, 0))
        return values.withColumn("before", upto - F.col("n"))
    slices = _slices(number, rows_per_slice)
    sort = [_order(c, False) for c in ("scale", "part", "score")]
    laid = _laid_out(values, sort, slices).withColumn("_part", F.struct("scale", "part"))
    so_far = F.sum("n").over(Window.partitionBy("_slice", "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0))
    laid = laid.withColumn("_upto", so_far)
    edges = laid.groupBy("_slice").agg(
        F.min_by("_part", "_at").alias("_first"),
        F.max_by("_part", "_at").alias("_last"),
        F.max_by("_upto", "_at").alias("_held"),
    )
    along = Window.orderBy("_slice")
    run = F.sum("_held").over(Window.partitionBy("_last").orderBy("_slice"))
    edges = edges.withColumn("_run", run)
    goes_on = F.lag("_last").over(along).eqNullSafe(F.col("_first"))
    carry = F.when(goes_on, F.lag("_run").over(along)).otherwise(0)
    edges = edges.withColumn("_carry", carry).select("_slice", "_first", "_carry")
    carried = F.when(F.col("_part").eqNullSafe(F.col("_first")), F.col("_carry")).otherwise(0)
    before = F.col("_upto") - F.col("n") + carried
    return laid.join(_few(edges, slices), "_slice").select("scale", "part", "score", "n", before.alias("before"))


def _comparable(columns: list[Column]) -> Column:
    """Keys as one value that compares in their order, NULLs last."""
    return F.struct(*[x for c in columns for x in (c.isNull(), c)])


def _cut_keys(
    narrow: DataFrame, keys: list[str], placed: DataFrame, ends: dict[str, list[int]], rows_per_slice: int | None
) -> dict[tuple[str, int], tuple[float | None, list[Any]]]:
    """For each end of a tile that lies within a value's rows: that value, and the last key before the end.

    Collects as many rows as there are ends.
    """
    within = [
        (F.col("scale") == scale) & (F.col("before") < end) & (F.col("before") + F.col("n") > end)
        for scale, numbers in ends.items()
        for end in numbers
    ]
    if not within:
        return {}
    cut = placed.where(reduce(lambda a, b: a | b, within)).collect()
    if not cut:
        return {}
    tied = [(F.col("scale") == r["scale"]) & F.col("score").eqNullSafe(F.lit(r["score"])) for r in cut]
    rows = narrow.where(reduce(lambda a, b: a | b, tied)).select(*keys, "scale", "score")
    number = sum(r["n"] for r in cut)
    if _fits(number, rows_per_slice):
        by_key = Window.partitionBy("scale", "score").orderBy(*[_order(k, False) for k in keys])
        numbered = rows.withColumn("row_number", F.row_number().over(by_key).cast("bigint"))
    else:
        numbered = positions(scratch.durable(rows, "tied"), keys, [], ["scale", "score"], rows_per_slice, number)
    ended = [
        {end: end - r["before"] for end in ends[r["scale"]] if r["before"] < end < r["before"] + r["n"]} for r in cut
    ]
    which = F.coalesce(
        *[F.when(t & F.col("row_number").isin(list(e.values())), F.lit(i)) for i, (t, e) in enumerate(zip(tied, ended))]
    )
    last = numbered.select(which.alias("_which"), "row_number", *keys).where(F.col("_which").isNotNull()).collect()
    found = {(r[0], r[1]): list(r)[2:] for r in last}
    return {
        (r["scale"], end): (r["score"], found[i, place])
        for i, (r, e) in enumerate(zip(cut, ended))
        for end, place in e.items()
    }


def score_scales(
    df: DataFrame,
    keys: list[str],
    scales: dict[str, tuple[str | None, str, bool]],
    tiles: dict[str, tuple[str, int]] | None = None,
    ranks: dict[str, str] | None = None,
    rows_per_slice: int | None = None,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """``df`` with several tiles and ranks, without sorting its rows.

    ``scales`` maps a name to (group column or None, numeric value column,
    descending). ``tiles`` maps an output column to (scale without group, number
    of tiles), ``ranks`` an output column to a scale. ``keys`` are unique
    together; ties of tiles go by them. NULL values come last.

    The rows of each value are counted; a rank is the number of rows with smaller
    values and one. Where the values are few they are broadcast to the rows,
    which are then not shuffled; otherwise they are joined, frequent values in
    pieces. ``df`` is read several times, so pass a stored table.
    """
    tiles, ranks = tiles or {}, ranks or {}
    if any(scales[name][0] for name, _ in tiles.values()):
        raise ValueError("tiles need a scale without group")
    rows = df.count()
    entry = {
        name: (
            (F.col(group) if group else F.lit(None)).cast("string"),
            (-F.col(value) if desc else F.col(value)).cast("double"),
        )
        for name, (group, value, desc) in scales.items()
    }
    structs = [F.struct(F.lit(name).alias("scale"), p.alias("part"), v.alias("score")) for name, (p, v) in entry.items()]
    narrow = df.select(*keys, F.explode(F.array(*structs)).alias("entry")).select(*keys, "entry.*")
    counted = narrow.groupBy("scale", "part", "score").agg(F.count(F.lit(1)).alias("n"))
    values = scratch.durable(counted, "scale-values")
    placed = scratch.durable(_rows_before(values, rows_per_slice), "scale-places")
    ends: dict[str, list[int]] = {}
    for name, number in tiles.values():
        ends[name] = sorted({*ends.get(name, []), *_ends(rows, number)})
    cuts = _cut_keys(narrow, keys, placed, ends, rows_per_slice)

    def outputs(before: dict[str, Column], score: dict[str, Column]) -> dict[str, Column]:
        mine = _comparable([F.col(k) for k in keys])
        out = {}
        for column, (name, number) in tiles.items():
            tile = F.lit(1)
            for end in _ends(rows, number):
                # Rows that tie over the end of a tile stand after it by their keys.
                after = before[name] >= end
                if (name, end) in cuts:
                    value, key = cuts[name, end]
                    types = [df.schema[k].dataType for k in keys]
                    last = _comparable([F.lit(x).cast(t) for x, t in zip(key, types)])
                    after = after | (score[name].eqNullSafe(F.lit(value)) & (mine > last))
                tile = tile + after.cast("int")
            out[column] = tile
        return out | {column: before[name] + 1 for column, name in ranks.items()}

    if joins.is_small(placed, broadcast_rows):
        wide = df
        for k, (name, (part, score)) in enumerate(entry.items()):
            mine = placed.where(F.col("scale") == name).select(
                F.col("part").alias(f"_part{k}"), F.col("score").alias(f"_score{k}"), F.col("before").alias(f"_before{k}")
            )
            same = score.eqNullSafe(F.col(f"_score{k}")) & part.eqNullSafe(F.col(f"_part{k}"))
            wide = wide.join(F.broadcast(mine), same, "left")
        made = outputs(
            {name: F.col(f"_before{k}") for k, name in enumerate(entry)},
            {name: score for name, (_, score) in entry.items()},
        )
        return wide.select(*[F.col(c) for c in df.columns], *[c.alias(name) for name, c in made.items()])

    lookup = placed.select(F.struct("scale", "part", "score").alias("value"), "n", "before")
    hot = scratch.durable(joins.hot_keys(lookup, "value", "n"), "hot-values")
    valued = narrow.select(*keys, F.struct("scale", "part", "score").alias("value"))
    found = joins.salted_join(valued, lookup.drop("n"), "value", hot, keys[0])
    at = {name: F.max(F.when(F.col("value.scale") == name, F.col("before"))).alias(f"_before{k}") for k, name in enumerate(entry)}
    spread = found.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(*at.values())
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys])
    made = outputs(
        {name: F.col(f"_before{k}") for k, name in enumerate(entry)},
        {name: score for name, (_, score) in entry.items()},
    )
    return df.join(spread, same).select(*[F.col(c) for c in df.columns], *[c.alias(name) for name, c in made.items()])
