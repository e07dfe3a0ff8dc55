"""Stored tables bucketed by key, merged by a single join that leaves the stored side where it lies.

The rows of a key are in one bucket, so a full outer join with the arriving
rows shuffles only those: to the table's buckets. Every row of the target is
read once, and its update, the insert of new keys and the rows that stay as
they are all come out of that join. Keys are unique on both sides, so no
bucket is skewed by a key; rows without a key match nothing and are kept.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlane import scratch
from marketlane.operators.upsert import require_unique

_NEW, _ARRIVED, _STORED = "_new_", "_arrived", "_stored"


@dataclass(frozen=True)
class Keyed:
    """A bucketed table; ``rows`` reads it."""

    spark: SparkSession
    name: str
    path: str
    keys: tuple[str, ...]
    buckets: int

    @property
    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def forget(self) -> None:
        """Take the table out of the catalogue; its files stay until ``scratch.clear``."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def store(rows: DataFrame, keys: list[str], buckets: int | None = None, dealt: bool = False) -> Keyed:
    """Write ``rows`` bucketed and sorted by key, one file a bucket.

    As many buckets as shuffle partitions unless given: choose both so that a
    bucket is about 200 MB. ``dealt`` says that each task of ``rows`` already
    holds whole buckets, as the result of a merge does; it is then not shuffled.
    """
    spark = rows.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, path = f"keyed_{uuid.uuid4().hex}", scratch.new_dir(spark, "keyed")
    held = rows if dealt else rows.repartition(n, *keys)
    held.write.bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return Keyed(spark, name, path, tuple(keys), n)


def joined(target: DataFrame, source: DataFrame, keys: list[str], how: str = "full_outer") -> DataFrame:
    """Both sides of each key: the target's columns, the source's as ``_new_*``, and which side has the key."""
    new = source.select(*[F.col(c).alias(f"{_NEW}{c}") for c in source.columns], F.lit(True).alias(_ARRIVED))
    on = [F.col(k) == F.col(f"{_NEW}{k}") for k in keys]
    return target.withColumn(_STORED, F.lit(True)).join(new, on, how)


def arrived() -> Column:
    return F.coalesce(F.col(_ARRIVED), F.lit(False))


def stored() -> Column:
    return F.coalesce(F.col(_STORED), F.lit(False))


def merge(
    target: Keyed | DataFrame,
    source: DataFrame,
    update: list[str],
    insert: list[str] | None = None,
    newer_by: str | list[str] | None = None,
    keys: list[str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """The whole target after the merge.

    A key in both gets the source's ``update`` columns; a key only in the
    source is inserted with its ``insert`` columns (all by default), the others
    NULL. With ``newer_by`` a row is updated only by one whose value there is
    larger; of several columns the first that differs decides, NULL is smallest. ``source`` is read twice: pass a stored table. A key it holds more
    than once is refused; ``unique`` says that none is, and it is read once.
    ``keys`` is needed only for a plain frame as target.
    """
    keys = list(target.keys) if isinstance(target, Keyed) else list(keys or ())
    rows = target.rows if isinstance(target, Keyed) else target
    if not unique:
        require_unique(source, keys)
    given = set(source.columns if insert is None else insert)
    wins = arrived()
    if newer_by is not None:
        order = [newer_by] if isinstance(newer_by, str) else newer_by
        old, new = (F.struct(*[F.col(side + c).alias(c) for c in order]) for side in ("", _NEW))
        wins = wins & (new > old)
    cells = []
    for f in rows.schema.fields:
        new = F.col(f"{_NEW}{f.name}") if f.name in source.columns else F.lit(None)
        kept = F.when(wins, new).otherwise(F.col(f.name)) if f.name in update else F.col(f.name)
        fresh = new if f.name in given else F.lit(None)
        cells.append(F.when(stored(), kept).otherwise(fresh).cast(f.dataType).alias(f.name))
    return joined(rows, source, keys).select(*cells)


def merged(target: Keyed, source: DataFrame, update: list[str], insert: list[str] | None = None, newer_by: str | None = None) -> Keyed:
    """``merge`` stored in the same buckets. The join leaves each bucket in one task, so nothing is shuffled to write."""
    return store(merge(target, source, update, insert, newer_by), list(target.keys), target.buckets, dealt=True)
