"""Every version of a keyed table as rows with the span of time in which they held.

Rows that hold now lie in a table bucketed by key, with the moment and the
number of the change that made them. A change joins that table once, moves the
rows it ends to ``closed`` with the moment and number that ended them, and
stores the rows that hold from then on. Reading as of a moment or a number is a
filter on the spans: no log, nothing collected, and the present is read in the
same time after one change or a hundred. Ended rows are stored by the number
that ended them, so a state reads only those that ended after it.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlane import scratch
from marketlane.functions.columns import ts_lit
from marketlane.functions.money import money_sum_where
from marketlane.operators import keyed
from marketlane.operators.upsert import DuplicateKeys, require_unique

UPSERT, DELETE = "U", "D"
FROM_AT, FROM_NO, TO_AT, TO_NO = "valid_from", "from_no", "valid_to", "to_no"


@dataclass(frozen=True)
class Timeline:
    current: keyed.Keyed
    closed: str  # folder of ended rows, by the number of the change that ended them
    number: int  # of the last change
    at: dt.datetime

    @property
    def spark(self) -> SparkSession:
        return self.current.spark

    @property
    def columns(self) -> list[str]:
        return [c for c in self.current.rows.columns if c not in (FROM_AT, FROM_NO)]


def _since(rows: DataFrame, at: dt.datetime, number: int) -> DataFrame:
    return rows.withColumns({FROM_AT: ts_lit(at), FROM_NO: F.lit(number).cast("bigint")})


def start(rows: DataFrame, keys: list[str], at: dt.datetime, buckets: int | None = None) -> Timeline:
    """The first change: ``rows`` hold from ``at`` on. Keys must be unique."""
    current = keyed.store(_since(rows, at, 1), keys, buckets)
    try:
        require_unique(current.rows, keys)  # a key's rows are in one bucket, so nothing is shuffled
    except DuplicateKeys:
        current.forget()
        raise
    closed = scratch.new_dir(rows.sparkSession, "closed")
    empty = current.rows.limit(0).withColumns({TO_AT: ts_lit(at), TO_NO: F.lit(0).cast("bigint")})
    empty.write.partitionBy(TO_NO).parquet(closed)
    return Timeline(current, closed, 1, at)


def record(timeline: Timeline, changes: DataFrame, at: dt.datetime, update: list[str] | None = None) -> Timeline:
    """The timeline after changes at ``at``, which may not lie before the last.

    ``_op`` marks deletes; without it each row is an upsert that replaces the
    ``update`` columns (all by default) of a stored key, or is inserted. A key
    given twice is refused; a delete of an absent key changes nothing.
    ``changes`` is read several times: pass a stored table.
    """
    if at < timeline.at:
        raise ValueError(f"a change at {at} would come before the last at {timeline.at}")
    keys, number = list(timeline.current.keys), timeline.number + 1
    require_unique(changes, keys)
    given = changes if "_op" in changes.columns else changes.withColumn("_op", F.lit(UPSERT))
    rows = timeline.current.rows
    both = keyed.joined(rows, given, keys, "full_outer")
    ends = keyed.joined(rows, given, keys, "inner").select(*rows.columns, ts_lit(at).alias(TO_AT), F.lit(number).cast("bigint").alias(TO_NO))
    ends.write.mode("append").partitionBy(TO_NO).parquet(timeline.closed)
    wanted = set(timeline.columns if update is None else update) | {FROM_AT, FROM_NO}
    cells = []
    for f in rows.schema.fields:
        if f.name in (FROM_AT, FROM_NO):
            new = ts_lit(at) if f.name == FROM_AT else F.lit(number)
        else:
            new = F.col(f"_new_{f.name}") if f.name in changes.columns else F.lit(None)
        kept = F.when(keyed.arrived(), new).otherwise(F.col(f.name)) if f.name in wanted else F.col(f.name)
        cells.append(F.when(keyed.stored(), kept).otherwise(new).cast(f.dataType).alias(f.name))
    holds = F.coalesce(F.col("_new__op") != DELETE, F.lit(True))
    current = keyed.store(both.where(holds).select(*cells), keys, timeline.current.buckets, dealt=True)
    return replace(timeline, current=current, number=number, at=at)


def _spans(timeline: Timeline, more: list[str]) -> DataFrame:
    """Rows of all spans; those that hold now have no end."""
    rows = timeline.current.rows
    held = rows.withColumns({TO_AT: F.lit(None).cast("timestamp_ntz"), TO_NO: F.lit(None).cast("bigint")})
    ended = timeline.spark.read.schema(held.schema).parquet(timeline.closed)
    return held.select(*more).unionByName(ended.select(*more))


def _held_at(moment: dt.datetime | int) -> Column:
    """Whether a span covers a moment or the number of a change."""
    if isinstance(moment, int):
        return (F.col(FROM_NO) <= moment) & (F.col(TO_NO).isNull() | (F.col(TO_NO) > moment))
    then = ts_lit(moment)
    return (F.col(FROM_AT) <= then) & (F.col(TO_AT).isNull() | (F.col(TO_AT) > then))


def as_of(timeline: Timeline, moment: dt.datetime | int) -> DataFrame:
    """The state at a moment, or after a change by its number; empty before the first."""
    present = moment >= (timeline.number if isinstance(moment, int) else timeline.at)
    if present:
        return timeline.current.rows.select(*timeline.columns)
    spans = _spans(timeline, [*timeline.columns, FROM_AT, FROM_NO, TO_AT, TO_NO])
    return spans.where(_held_at(moment)).select(*timeline.columns)


def compare(timeline: Timeline, moments: dict[str, dt.datetime | int], amount: str, count_as: str, total_as: str) -> DataFrame:
    """Rows and total of several states, side by side, from one pass over the spans."""
    spans = _spans(timeline, [amount, FROM_AT, FROM_NO, TO_AT, TO_NO])
    sums = []
    for k, moment in enumerate(moments.values()):
        sums += [F.count_if(_held_at(moment)).alias(f"n{k}"), money_sum_where(_held_at(moment), amount).alias(f"t{k}")]
    lines = [
        F.struct(F.lit(label).alias("version"), F.col(f"n{k}").alias(count_as), F.when(F.col(f"n{k}") > 0, F.col(f"t{k}")).alias(total_as))
        for k, label in enumerate(moments)
    ]
    return spans.agg(*sums).select(F.inline(F.array(*lines)))
