"""Arriving versions of keyed rows, the newest of each key held in Spark's state store.

The stream is an aggregation: the newest version per key. Spark keeps it in the
state store, partitioned by key and checkpointed, and hands each batch only
the keys that arrived in it. Those are written to a folder of their own, so the
time of a batch depends on what arrives, not on the table, its history or the
batches before. A replayed batch writes the same rows to the same folder.

The table is its bucketed base and the newest of the rows in those folders, by
one join that leaves the base where it lies. ``fold`` stores that as the new
base and removes the folders it took in. Until they are gone both hold the same
versions, and a version that is already there changes nothing, so a lost fold is
repeated without harm. Call it between runs, as often as the folders' rows are
worth a pass over the base.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlane import scratch
from marketlane.operators import keyed

_WHOLE, _NEWEST = "_whole_", "_newest_"
# State lies on the executors' disks; a batch uploads what it changed.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@dataclass(frozen=True)
class KeyFeed:
    base: keyed.Keyed
    changes: str  # folder with one folder a batch
    version_by: str

    @property
    def spark(self) -> SparkSession:
        return self.base.spark

    @property
    def keys(self) -> list[str]:
        return list(self.base.keys)


def _loose(keys: list[str]) -> Column:
    """Whether a row lacks a part of its key."""
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def newest(rows: DataFrame, keys: list[str], version_by: str) -> DataFrame:
    """The newest version of each key; of equally new ones, that with the largest other values.

    Works on streams and tables. Versions are compared within each task before
    the shuffle, so a key with very many versions sends one row a task. Rows
    without a whole key are told apart by all their values: repeats fall together.
    """
    others = [c for c in rows.columns if c != version_by and c not in keys]
    whole = F.when(_loose(keys), F.struct(*[F.col(c) for c in rows.columns]))
    best = F.max(F.struct(F.col(version_by), *[F.col(c) for c in others]))
    held = rows.groupBy(*keys, whole.alias(_WHOLE)).agg(best.alias(_NEWEST))
    return held.select(*[F.col(c) if c in keys else F.col(_NEWEST)[c].alias(c) for c in rows.columns])


def start(rows: DataFrame, keys: list[str], version_by: str, buckets: int | None = None) -> KeyFeed:
    """A feed whose table is ``rows``; keys must be unique, rows without a key are kept."""
    feed = KeyFeed(keyed.store(rows, keys, buckets), scratch.new_dir(rows.sparkSession, "changes"), version_by)
    feed.base.rows.limit(0).write.parquet(f"{feed.changes}/batch=none")
    return feed


@contextmanager
def _set(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings that a query takes over when it starts."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def listen(feed: KeyFeed, stream: DataFrame, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Take in whole rows of the table's columns from ``stream``, in any order and any number of times.

    A row is replaced by a newer version only, of equally new ones by that with
    larger other values, so the table is the ``newest`` of all rows that ever
    came, whenever it is folded. With a new checkpoint the stream is read from
    its beginning and nothing changes. The number of state
    partitions is that of shuffle partitions when a checkpoint is first used.
    """
    rows = stream.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in feed.base.rows.schema.fields])

    def write(batch: DataFrame, number: int) -> None:
        # Read once: reading a batch again would run the state a second time.
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch.write.mode("overwrite").parquet(f"{feed.changes}/batch={run}-{number}")

    writer = newest(rows, feed.keys, feed.version_by).writeStream.outputMode("update").foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint)
    with _set(feed.spark, STATE):
        return (writer.trigger(availableNow=True) if available_now else writer).start()


def _with(feed: KeyFeed, folders: list[str]) -> DataFrame:
    """The table with the changes in some folders."""
    held, spark = feed.base.rows, feed.spark
    if not folders:
        return held
    news = newest(spark.read.schema(held.schema).parquet(*folders), feed.keys, feed.version_by)
    loose = _loose(feed.keys)
    update = [c for c in held.columns if c not in feed.keys]
    order = [feed.version_by, *(c for c in update if c != feed.version_by)]
    whole = keyed.merge(held, news.where(~loose), update, newer_by=order, keys=feed.keys, unique=True)
    return whole.unionByName(news.where(loose).subtract(held.where(loose)))


def current(feed: KeyFeed) -> DataFrame:
    """The table as it is after the batches that have ended."""
    return _with(feed, scratch.finished(feed.spark, feed.changes))


def fold(feed: KeyFeed) -> KeyFeed:
    """The same table with the changes taken into its base. The feed given is not to be read any more."""
    folders = scratch.finished(feed.spark, feed.changes)
    base = keyed.store(_with(feed, folders), feed.keys, feed.base.buckets, dealt=True)
    scratch.delete(feed.spark, folders)
    return replace(feed, base=base)
