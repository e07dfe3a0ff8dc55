"""Lines that stand in many documents: exact reference counts behind sharded cuckoo filters.

A line's key is the line without the white space [\\x20\\x09-\\x0D] at its ends
and with A-Z lower-cased; keys are held as 128-bit digests. ``Store.refs`` has
for every key the number of documents it stands in. ``Store.filters`` has one
cuckoo filter for each shard of digests with the keys that stand in at least
``least`` documents. ``insert`` and ``delete`` add and take away whole
documents: they change the counts, and take only the keys that crossed
``least`` into or out of the filters. So deleting what was inserted gives the
earlier store and the earlier results again.

``drop`` sends each document's keys to their shard, where the filter turns away
nearly all; the few that pass are confirmed by the exact counts, so the filter's
errors never show. Shards are cut further by document, so a line that a third
of the documents have is dealt out evenly; a filter is held one at a time.

Lines are split at \\n. A null or empty text is one empty line; keys of no code
points are never counted or dropped. A line counts once for each row it stands
in, so repeated rows count again. Rows with a null id are documents like
others. Other columns are carried along; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlane import scratch
from marketlane.llm import cuckoo

# Keys in one filter at most, by which the shards are counted, and cuts of a shard when documents are looked up.
SHARD_KEYS = 200_000
CUTS = 64


@dataclass(frozen=True)
class Store:
    refs: DataFrame  # key binary, refs long
    filters: DataFrame  # shard int, body binary
    shards: int
    least: int


def _digests(text: bytes | None) -> list[bytes]:
    """Key digests of all lines, empty where the key is."""
    lines = (text or b"").lower().split(b"\n")
    return [xxhash.xxh3_128_digest(k) if (k := line.strip()) else b"" for line in lines]


def keys(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Each document's distinct keys with its id."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body, at = [], []
            for i, t in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                found = set(_digests(t)) - {b""}
                body.extend(found)
                at.extend([i] * len(found))
            yield pa.record_batch({"key": pa.array(body, pa.binary()), "id": batch.column(0).take(pa.array(at, pa.int32()))})

    return docs.select(key, text).mapInArrow(run, f"key binary, id {kind}")


def _shard(shards: int):
    return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")


def _changed(filters: DataFrame, changes: DataFrame) -> DataFrame:
    """Filters after taking in (sign 1) and out (sign -1) the keys of ``changes``."""
    rows = filters.select("shard", F.lit(0).alias("sign"), "body").unionByName(
        changes.select("shard", "sign", F.col("key").alias("body"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, None

        def out():
            return pa.record_batch({"shard": pa.array([shard], pa.int32()), "body": pa.array([held.to_bytes()], pa.binary())})

        for batch in batches:
            for s, sign, body in zip(*(batch.column(c).to_pylist() for c in ("shard", "sign", "body"))):
                if s != shard:
                    if held is not None:
                        yield out()
                    shard, held = s, cuckoo.Filter()
                if sign == 0:
                    held = cuckoo.Filter(body)
                elif sign > 0:
                    held.insert(cuckoo.as_digests([body]))
                else:
                    held.remove(cuckoo.as_digests([body]))
        if held is not None:
            yield out()

    dealt = rows.repartition("shard").sortWithinPartitions("shard", F.col("sign") != 0)
    return dealt.mapInArrow(run, "shard int, body binary")


def empty(docs: DataFrame, least: int, shards: int) -> Store:
    spark = docs.sparkSession
    none = spark.range(0)
    return Store(
        none.select(F.lit(b"").alias("key"), F.col("id").alias("refs")),
        none.select(F.col("id").cast("int").alias("shard"), F.lit(b"").alias("body")),
        shards,
        least,
    )


def _moved(store: Store, docs: DataFrame, sign: int) -> Store:
    delta = keys(docs).groupBy("key").agg((F.count(F.lit(1)) * sign).alias("delta"))
    old = store.refs.select("key", F.col("refs").alias("old"), F.lit(0).cast("long").alias("delta"))
    new = delta.select("key", F.lit(0).cast("long").alias("old"), "delta")
    both = old.unionByName(new).groupBy("key").agg(F.sum("old").alias("old"), F.sum("delta").alias("delta"))
    both = scratch.durable(both.withColumn("refs", F.col("old") + F.col("delta")), "line-refs")
    was, now = F.col("old") >= store.least, F.col("refs") >= store.least
    crossed = both.where(was != now).select("key", F.when(now, 1).otherwise(-1).alias("sign"))
    shards = store.shards or 1 + crossed.count() // SHARD_KEYS
    filters = _changed(store.filters, crossed.withColumn("shard", _shard(shards)))
    refs = both.where("refs > 0").select("key", "refs")
    return Store(refs, scratch.durable(filters, "line-filters"), shards, store.least)


def build(docs: DataFrame, least: int) -> Store:
    """The store of a corpus; shards are counted from its keys."""
    return _moved(empty(docs, least, 0), docs, 1)


def insert(store: Store, docs: DataFrame) -> Store:
    return _moved(store, docs, 1)


def delete(store: Store, docs: DataFrame) -> Store:
    """The store without documents that were inserted before."""
    return _moved(store, docs, -1)


def _passed(found: DataFrame, store: Store) -> DataFrame:
    """Rows (key, id) that their shard's filter does not turn away."""
    cut = F.pmod(F.xxhash64("id", "key"), F.lit(CUTS)).cast("int")
    kind = found.schema["id"].dataType
    lines = found.select(_shard(store.shards).alias("shard"), cut.alias("cut"), F.lit(1).alias("kind"), "key", "id")
    held = store.filters.select(
        "shard",
        F.explode(F.sequence(F.lit(0), F.lit(CUTS - 1))).alias("cut"),
        F.lit(0).alias("kind"),
        F.col("body").alias("key"),
        F.lit(None).cast(kind).alias("id"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held = None, cuckoo.Filter()
        for batch in batches:
            shards, kinds = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
            start = 0
            while start < len(kinds):
                if kinds[start] == 0:
                    shard, held, start = shards[start], cuckoo.Filter(batch.column("key")[start].as_py()), start + 1
                    continue
                end = start
                while end < len(kinds) and kinds[end] == 1 and shards[end] == shards[start]:
                    end += 1
                if shards[start] == shard:  # a shard without a filter has no frequent key
                    part = batch.slice(start, end - start)
                    yes = held.contains(cuckoo.as_digests(part.column("key").to_pylist()))
                    yield part.select(["key", "id"]).filter(pa.array(yes))
                start = end

    dealt = lines.unionByName(held).repartition("shard", "cut").sortWithinPartitions("shard", "cut", "kind")
    return dealt.mapInArrow(run, f"key binary, id {kind.simpleString()}")


def drop(docs: DataFrame, store: Store, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``text`` without the lines whose keys stand in ``least`` documents, n_lines and n_dropped."""
    frequent = store.refs.where(F.col("refs") >= store.least).select("key")
    hits = _passed(keys(docs, text, key), store).join(frequent, "key", "left_semi")
    per_doc = hits.groupBy("id").agg(F.collect_set("key").alias("_keys")).withColumnRenamed("id", "_id")

    @F.arrow_udf("struct<kept: string, n_lines: long, n_dropped: long>")
    def without(texts: pa.Array, dropped: pa.Array) -> pa.Array:
        out = []
        for t, gone in zip(texts.cast(pa.binary()).to_pylist(), dropped.to_pylist()):
            lines = (t or b"").split(b"\n")
            kept = lines
            if gone:
                gone = set(gone)
                kept = [x for x, d in zip(lines, _digests(t)) if d not in gone]
            out.append((b"\n".join(kept).decode(), len(lines), len(lines) - len(kept)))
        kept, n, n_dropped = zip(*out) if out else ((), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(kept, pa.string()), pa.array(n, pa.int64()), pa.array(n_dropped, pa.int64())],
            names=["kept", "n_lines", "n_dropped"],
        )

    names = [c for c in docs.columns if c.lower() not in {"n_lines", "n_dropped"}]
    # The columns travel in one, so that none can clash with those of the join.
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"))
    joined = packed.join(per_doc, F.col(f"row.`{key}`").eqNullSafe(F.col("_id")), "left")
    out = joined.select("row", without(F.col(f"row.`{text}`"), F.col("_keys")).alias("out"))
    kept = [(F.col("out.kept") if c == text else F.col(f"row.`{c}`")).alias(c) for c in names]
    return out.select(*kept, F.col("out.n_lines").alias("n_lines"), F.col("out.n_dropped").alias("n_dropped"))
