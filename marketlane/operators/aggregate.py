"""Grouped measures next to distinct counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_distinct_counts(
    df: DataFrame, keys: list[str], measures: dict[str, Column], distinct: dict[str, str]
) -> DataFrame:
    """``groupBy(keys)`` with ordinary ``measures`` and exact distinct counts (output name -> column).

    In one aggregation Spark repeats every row per distinct column and carries
    all measures through that shuffle. Apart, the measures are combined before
    their shuffle and the distinct counts move only keys and counted columns.
    ``df`` is read twice: pass a stored table. Groups with a NULL key are kept.
    """
    sums = df.groupBy(*keys).agg(*[column.alias(name) for name, column in measures.items()])
    counts = df.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        *[F.countDistinct(column).alias(name) for name, column in distinct.items()]
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return sums.join(counts, same).drop(*[f"_{k}" for k in keys])
