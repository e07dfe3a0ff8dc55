"""Update-or-insert by key, and the high-water mark that feeds it.

Only rows of the target whose key arrives are touched. When the arriving rows
are few they are broadcast and the target is read once without a shuffle; when
they are many both sides are shuffled by key, which is unique on each side.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlane.functions.columns import ts_lit
from marketlane.operators.joins import is_small
from marketlane.operators.quality import duplicate_keys

EPOCH = dt.datetime(1970, 1, 1)


class DuplicateKeys(ValueError):
    """The arriving rows hold a key more than once, so which one wins is undefined."""


def require_unique(source: DataFrame, keys: list[str]) -> None:
    if not duplicate_keys(source, keys).isEmpty():
        raise DuplicateKeys(f"several arriving rows share {', '.join(keys)}")


def high_water_mark(df: DataFrame, column: str) -> Column:
    """Newest value of ``column`` as a scalar subquery, the epoch for an empty table."""
    return df.agg(F.coalesce(F.max(column), ts_lit(EPOCH))).scalar()


def newest_per_key(df: DataFrame, keys: list[str], by: str) -> DataFrame:
    """The last version of each key; of equally new ones, that with the largest other values.

    Spark prunes ``row_number = 1`` before the shuffle, so a key with very many
    versions sends one row per task.
    """
    order = [by, *(c for c in df.columns if c != by and c not in keys)]
    last = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return df.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def _updates(source: DataFrame, keys: list[str], update: list[str], small: bool) -> DataFrame:
    side = source.select(
        *keys, F.lit(True).alias("_arrived"), *[F.col(c).alias(f"_new_{c}") for c in update]
    )
    return F.broadcast(side) if small else side


def _inserts(
    target: DataFrame, source: DataFrame, keys: list[str], insert: list[str] | None, small: bool
) -> DataFrame:
    arriving = source.select(*keys)
    present = target.select(*keys).join(F.broadcast(arriving) if small else arriving, keys, "left_semi")
    fresh = source.join(present, keys, "left_anti")
    given = set(source.columns if insert is None else insert)
    return fresh.select(
        *[
            (F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
    )


def _updated(joined: DataFrame, target: DataFrame, update: list[str]) -> DataFrame:
    return joined.select(
        *[
            F.when(F.col("_arrived"), F.col(f"_new_{f.name}")).otherwise(F.col(f.name)).cast(f.dataType).alias(f.name)
            if f.name in update
            else F.col(f.name)
            for f in target.schema.fields
        ]
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: list[str],
    insert: list[str] | None = None,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """The whole target after the merge.

    A key in both gets the source's ``update`` columns; a key only in the
    source is inserted with its ``insert`` columns (all by default), the others
    NULL. ``source`` is read several times: pass a stored table.
    """
    require_unique(source, keys)
    small = is_small(source, broadcast_rows)
    joined = target.join(_updates(source, keys, update, small), keys, "left")
    return _updated(joined, target, update).unionByName(_inserts(target, source, keys, insert, small))


def changed_rows(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update: list[str],
    insert: list[str] | None = None,
    broadcast_rows: int | None = None,
    newer_by: str | None = None,
) -> DataFrame:
    """Only the rows the merge updates or inserts, in their new form.

    With ``newer_by``, a row is updated only by one whose value there is
    larger, so late and repeated versions change nothing.
    """
    require_unique(source, keys)
    small = is_small(source, broadcast_rows)
    extra = [] if newer_by is None or newer_by in update else [newer_by]
    joined = target.join(_updates(source, keys, [*update, *extra], small), keys, "inner")
    if newer_by is not None:
        arrived = F.col(f"_new_{newer_by}")
        joined = joined.where((arrived > F.col(newer_by)) | (F.col(newer_by).isNull() & arrived.isNotNull()))
    return _updated(joined, target, update).unionByName(_inserts(target, source, keys, insert, small))
