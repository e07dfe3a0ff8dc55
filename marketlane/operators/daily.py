"""Tables stored by period of their days, and aggregates kept per day that merge into totals.

A change of one day rewrites that day's period of the rows and of each
aggregate; the rest of the rows is not read. Totals over all time merge the
aggregates, which have one row per day and group at most. Exact distinct counts
merge as well: they are kept as the distinct values of each day.

A refresh that was cut short is repeated and gives the same tables.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlane import scratch
from marketlane.functions.columns import date_lit

PERIOD = "_period_"
DAY, MONTH = "day", "month"
# A period with more rows than this is aggregated in pieces.
ROWS_PER_PIECE = 500_000
_PIECE = "_piece_"


@dataclass(frozen=True)
class DayTable:
    """Rows by period of a day column; rows without a day have a period of their own."""

    spark: SparkSession
    path: str
    day: str
    per: str
    schema: T.StructType

    @property
    def rows(self) -> DataFrame:
        return self._all.drop(PERIOD)

    @property
    def _all(self) -> DataFrame:
        period = T.StructField(PERIOD, T.DateType())
        return self.spark.read.schema(T.StructType([*self.schema.fields, period])).parquet(self.path)

    def within(self, periods: list[dt.date | None]) -> DataFrame:
        """The rows of some periods; only their files are read."""
        return self._all.where(_among(F.col(PERIOD), periods)).drop(PERIOD)


def period_of(day: Column, per: str) -> Column:
    return F.trunc(day, "month") if per == MONTH else day


def _among(period: Column, periods: list[dt.date | None]) -> Column:
    days = [date_lit(p) for p in periods if p is not None]
    listed = period.isin(*days) if days else F.lit(False)
    return listed | period.isNull() if None in periods else listed


def _write(rows: DataFrame, table: DayTable, mode: str) -> None:
    """Periods are gathered by size: small ones share a task, large ones have several."""
    placed = rows.withColumn(PERIOD, period_of(F.col(table.day), table.per)).hint("rebalance", F.col(PERIOD))
    writer = placed.write.mode(mode).partitionBy(PERIOD).option("partitionOverwriteMode", "dynamic")
    writer.parquet(table.path)


def store(rows: DataFrame, day: str, label: str, per: str = DAY) -> DayTable:
    spark = rows.sparkSession
    table = DayTable(spark, scratch.new_dir(spark, label), day, per, rows.schema)
    _write(rows, table, "append")
    return table


def periods_of(rows: DataFrame, day: str, per: str) -> list[dt.date | None]:
    """The periods that rows lie in; as many as the calendar has, whatever the rows."""
    found = rows.select(period_of(F.col(day), per).alias("p")).distinct().collect()
    return sorted((r["p"] for r in found), key=lambda p: (p is not None, p))


def replace(table: DayTable, rows: DataFrame, periods: list[dt.date | None]) -> None:
    """Put ``rows`` in place of some periods; a period without rows is emptied.

    All of ``rows`` lie in ``periods``. They are read twice and must not be read
    from the table itself: pass a stored table.
    """
    _write(rows, table, "overwrite")
    gone = set(periods) - set(periods_of(rows, table.day, table.per))
    names = ["__HIVE_DEFAULT_PARTITION__" if p is None else p.isoformat() for p in gone]
    scratch.delete(table.spark, [f"{table.path}/{PERIOD}={name}" for name in names])


def upsert(table: DayTable, arrived: DataFrame, keys: list[str]) -> list[dt.date | None]:
    """Put whole rows in place of those with their keys; returns the periods whose rows changed.

    A row that moves to another day changes both periods. Of the table, keys and
    days are read whole to find where the keys lie, and rows of those periods only.
    Keys of ``arrived`` are unique; rows without a key are added.
    """
    new = arrived.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields])
    with scratch.held(new, "arrived") as new:
        known = new.select(*keys)
        moved = table.rows.select(*dict.fromkeys([*keys, table.day])).join(known, keys, "left_semi")
        periods = periods_of(moved.select(table.day).union(new.select(table.day)), table.day, table.per)
        whole = table.within(periods).join(known, keys, "left_anti").unionByName(new)
        with scratch.held(whole, "periods") as whole:
            replace(table, whole, periods)
    return periods


@dataclass(frozen=True)
class Partial:
    """Sums, least and largest values per day and group, by name and how they merge; without any, distinct groups."""

    keys: tuple[str, ...]
    sums: dict[str, Column] = field(default_factory=dict)
    least: dict[str, Column] = field(default_factory=dict)
    largest: dict[str, Column] = field(default_factory=dict)

    def of(self, rows: DataFrame, day: str) -> DataFrame:
        """One row for each day and group of ``rows``."""
        groups = [day, *(k for k in self.keys if k != day)]
        parts = [
            how(c).alias(name)
            for how, named in ((F.sum, self.sums), (F.min, self.least), (F.max, self.largest))
            for name, c in named.items()
        ]
        return rows.groupBy(*groups).agg(*parts) if parts else rows.select(*groups).distinct()


def _pieces(rows: DataFrame, period: Column) -> Column:
    """In how many pieces a row's period is aggregated; lists the periods with several, as many as the calendar has."""
    number = F.ceil(F.count(F.lit(1)) / F.lit(ROWS_PER_PIECE)).cast("int")
    found = rows.groupBy(period.alias("p")).agg(number.alias("n")).where("n > 1").collect()
    of_none = next((r["n"] for r in found if r["p"] is None), 1)
    several = [c for r in found if r["p"] is not None for c in (date_lit(r["p"]), F.lit(r["n"]))]
    listed = F.coalesce(F.try_element_at(F.create_map(*several), period), F.lit(1)) if several else F.lit(1)
    return F.when(period.isNull(), F.lit(of_none)).otherwise(listed)


def store_partial(partial: Partial, rows: DataFrame, day: str, label: str, per: str = DAY) -> DayTable:
    """``store`` of ``partial.of(rows, day)``, with one shuffle: by period and piece, which groups and layout share.

    A group lies in one piece of its period. ``rows`` are read twice: pass a stored table.
    """
    spark = rows.sparkSession
    period, groups = period_of(F.col(day), per), [day, *(k for k in partial.keys if k != day)]
    piece = F.pmod(F.xxhash64(*groups), _pieces(rows, period))
    read = rows.select(*groups, *[c.alias(name) for named in (partial.sums, partial.least, partial.largest) for name, c in named.items()])
    dealt = read.withColumns({PERIOD: period, _PIECE: piece}).repartition(PERIOD, _PIECE)
    merged = Partial(
        (PERIOD, _PIECE, *groups),
        *({name: F.col(name) for name in named} for named in (partial.sums, partial.least, partial.largest)),
    )
    found = merged.of(dealt, day).drop(_PIECE).select(day, *[c for c in groups if c != day], *partial.sums, *partial.least, *partial.largest, PERIOD)
    plain = found.drop(PERIOD)
    table = DayTable(spark, scratch.new_dir(spark, label), day, per, plain.schema)
    found.write.mode("append").partitionBy(PERIOD).parquet(table.path)
    return table


def refresh(table: DayTable, partial: Partial, rows: DataFrame, periods: list[dt.date | None]) -> None:
    """Compute the aggregates of some periods anew from all ``rows`` of those periods."""
    with scratch.held(partial.of(rows, table.day), "partials") as fresh:
        replace(table, fresh, periods)


def with_distinct(sums: DataFrame, keys: list[str], sets: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Groups with distinct counts (output name -> distinct values of each day, counted column). NULL keys meet."""
    for name, (values, column) in sets.items():
        counts = values.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.countDistinct(column).alias(name))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
        sums = sums.join(counts, same).drop(*[f"_{k}" for k in keys])
    return sums
