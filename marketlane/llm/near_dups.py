"""Near-duplicate documents by a multi-index Hamming join of b-bit MinHash signatures.

A document's set holds its distinct runs of five words (the whole sequence
where it has fewer). Equal sets form one class, and only classes are compared.
A class's signature has SYMBOLS minima, of which BITS bits are kept. A symbol of
two sets with similarity s differs with a chance of 1 - s, so ``layout`` takes
the number of errors that a linked pair exceeds with a chance below MISSED, and
cuts signatures into so many chunks that, by the pigeonhole principle, any two
signatures within that distance have a chunk with at most CHUNK_ERRORS errors.
All ways to leave out that many symbols of a chunk are enumerated as keys, so
such a pair always meets under a key.

Pairs that meet are confirmed on the full sets. First each member of a key is
held against the key's first member. Then, where members of a key are still in
different components, the pairs across components are confirmed, each under the
first key it meets under. Two exact bounds spare most of them: the smaller set
must reach the share of the larger, and both need enough shingles that some
other of these sets has too (an edit's own shingles are in no other set). Pairs
within one component cannot change it. So neither step lists the pairs of a
group, and none drops a link.

Documents without words (null, empty, white space) have empty sets and stay
alone. Rows with a null id get a null component and are kept. Rows that repeat
an id with the same text fall into one class. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlane import scratch
from marketlane.llm import wordhash
from marketlane.llm.components import components

WORDS = 5
SYMBOLS, BITS, CHUNK_ERRORS = 50, 16, 1
MISSED = 2e-5
# Members of a key that one tile of the pairwise step compares with as many others.
TILE = 2048


@dataclass(frozen=True)
class Layout:
    percent: int
    most_errors: int
    chunks: tuple[tuple[int, ...], ...]


def layout(percent: int) -> Layout:
    """Chunks for pairs of at least this similarity."""
    differs = 1 - percent / 100
    beyond, errors = 1.0, -1
    while beyond > MISSED:
        errors += 1
        beyond -= comb(SYMBOLS, errors) * differs**errors * (1 - differs) ** (SYMBOLS - errors)
    n = -(-(errors + 1) // (CHUNK_ERRORS + 1))
    return Layout(percent, n * (CHUNK_ERRORS + 1) - 1, tuple(tuple(map(int, c)) for c in np.array_split(np.arange(SYMBOLS), n)))


_rng = np.random.default_rng(85)
_TIMES = _rng.integers(1, 1 << 63, SYMBOLS, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _rng.integers(0, 1 << 63, SYMBOLS, np.uint64)
_KEYED = _rng.integers(1, 1 << 63, SYMBOLS, np.uint64) | np.uint64(1)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The low bits of the minima under SYMBOLS hash functions."""
    low = np.full(SYMBOLS, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), 4096):
        part = shingles[None, at : at + 4096] * _TIMES[:, None] + _PLUS[:, None]
        np.minimum(low, (part ^ (part >> np.uint64(32))).min(axis=1), out=low)
    return (wordhash.mix(low) & np.uint64((1 << BITS) - 1)).astype(np.uint16)


def chunk_keys(signatures: np.ndarray, plan: Layout) -> np.ndarray:
    """For each signature (a row) its keys: each chunk without each choice of CHUNK_ERRORS symbols."""
    weighted = (signatures.astype(np.uint64) + np.uint64(1)) * _KEYED
    out = []
    for chunk in plan.chunks:
        for out_of in combinations(chunk, min(CHUNK_ERRORS, len(chunk))):
            total = weighted[:, [k for k in chunk if k not in out_of]].sum(axis=1)
            out.append(wordhash.mix(total + np.uint64(len(out) + 1)))
    return np.stack(out, axis=1)


def sketches(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, two sums that stand for the set, and its signature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, one, two, sig = [], [], [], []
            for s in wordhash.shingle_sets(batch.column(1).cast(pa.binary()).to_pylist(), WORDS):
                n.append(len(s))
                one.append(int(s.sum()) - (1 << 63))
                two.append(int(wordhash.mix(s).sum()) - (1 << 63))
                sig.append(signature(s).tobytes())
            yield pa.record_batch({
                "doc_id": batch.column(0), "n_shingles": pa.array(n, pa.int64()), "set_a": pa.array(one, pa.int64()),
                "set_b": pa.array(two, pa.int64()), "signature": pa.array(sig, pa.binary()),
            })

    return docs.select(F.col(key).cast("long"), text).mapInArrow(
        run, "doc_id long, n_shingles long, set_a long, set_b long, signature binary"
    )


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SYMBOLS)


def members(classes: DataFrame, plan: Layout) -> DataFrame:
    """key, rep, first (smallest rep of the key) for each key that two classes or more have."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = chunk_keys(_signatures(batch.column("signature")), plan)
            rep = np.repeat(batch.column("rep").to_numpy(), keys.shape[1])
            yield pa.record_batch({"key": keys.ravel().view(np.int64), "rep": rep})

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows come sorted; the last row of a batch waits for what follows it.
        key, rep = np.zeros(0, np.int64), np.zeros(0, np.int64)
        last_key, last_first, alone = None, 0, False
        for batch in batches:
            key = np.concatenate([key, batch.column("key").to_numpy()])
            rep = np.concatenate([rep, batch.column("rep").to_numpy()])
            if len(key) < 2:
                continue
            new = np.concatenate([[last_key is None or key[0] != last_key], key[1:] != key[:-1]])
            start = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
            first = rep[start]
            if not new[0]:
                first[start == 0] = last_first
            many = ~new
            many[:-1] |= ~new[1:]
            give = len(key) - 1
            yield pa.record_batch({"key": key[:give][many[:give]], "rep": rep[:give][many[:give]], "first": first[:give][many[:give]]})
            last_key, last_first = key[give - 1], first[give - 1]
            key, rep = key[give:], rep[give:]
        if len(key) and last_key is not None and key[0] == last_key:
            yield pa.record_batch({"key": key, "rep": rep, "first": np.array([last_first])})

    keyed = classes.select("rep", "signature").mapInArrow(explode, "key long, rep long")
    return keyed.repartition("key").sortWithinPartitions("key", "rep").mapInArrow(shared, "key long, rep long, first long")


def sets(docs: DataFrame, wanted: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """rep and its whole set for the documents in ``wanted`` (rep)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            body = [s.tobytes() for s in wordhash.shingle_sets(batch.column(1).cast(pa.binary()).to_pylist(), WORDS)]
            yield pa.record_batch({"rep": batch.column(0), "body": pa.array(body, pa.binary())})

    texts = docs.select(F.col(key).cast("long").alias("rep"), text)
    return texts.join(wanted, "rep", "left_semi").mapInArrow(run, "rep long, body binary").dropDuplicates(["rep"])


def confirm(pairs: DataFrame, bodies: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets are similar enough."""

    @F.arrow_udf("boolean")
    def similar(a: pa.Array, b: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(a, b):
            x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
            small, large = (x, y) if len(x) <= len(y) else (y, x)
            if 100 * len(small) < percent * len(large):
                out.append(False)
                continue
            at = np.minimum(np.searchsorted(large, small), len(large) - 1)
            common = int((large[at] == small).sum())
            out.append(100 * common >= percent * (len(x) + len(y) - common))
        return pa.array(out, pa.bool_())

    left = pairs.join(bodies.select(F.col("rep").alias("u"), F.col("body").alias("a")), "u")
    both = left.join(bodies.select(F.col("rep").alias("v"), F.col("body").alias("b")), "v")
    return both.where(similar("a", "b")).select("u", "v")


def shared_sizes(bodies: DataFrame, wanted: DataFrame) -> DataFrame:
    """rep and n_shared: how many shingles of its set another of the ``wanted`` sets has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rep, body in zip(batch.column("rep").to_pylist(), batch.column("body")):
                shingles = np.frombuffer(body.as_buffer(), np.int64)
                yield pa.record_batch({"shingle": shingles, "rep": np.full(len(shingles), rep)})

    each = bodies.join(wanted, "rep", "left_semi").select("rep", "body").mapInArrow(run, "shingle long, rep long")
    common = each.groupBy("shingle").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("shingle")
    return each.join(common, "shingle", "left_semi").groupBy("rep").agg(F.count(F.lit(1)).alias("n_shared"))


def _across(grouped: DataFrame, plan: Layout) -> DataFrame:
    """Pairs of a key's members in different components that may be similar enough.

    A key's members are dealt out in tiles of TILE by TILE, so that no task
    holds more than two blocks of them.
    """
    counts = grouped.groupBy("key").agg(F.count("rep").alias("members"))
    counts = counts.select("key", F.ceil(F.col("members") / TILE).cast("int").alias("blocks"))
    dealt = (
        grouped.join(counts, "key")
        .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("block", "other"))
        .withColumn("j", F.greatest("block", "other"))
        .select("key", "i", "j", "block", "rep", "component", "n_shingles", "n_shared", "signature")
    )

    def pairs(key: int, rows: list) -> pa.RecordBatch:
        block, rep, comp, n, shared = (np.concatenate([r[k] for r in rows]) for k in range(5))
        sig = np.concatenate([r[5] for r in rows])
        keys = chunk_keys(sig, plan)
        mine = int(np.argmax(keys[0] == np.int64(key).astype(np.uint64)))
        several = block.min() != block.max()
        u, v = [], []
        for k in range(len(rep)):
            test = (comp != comp[k]) & (rep > rep[k])
            # Sizes, and the least common shingles for the similarity.
            test &= 100 * np.minimum(n, n[k]) >= plan.percent * np.maximum(n, n[k])
            test &= (100 + plan.percent) * np.minimum(shared, shared[k]) >= plan.percent * (n + n[k])
            if several:
                test &= block != block[k]
            at = np.flatnonzero(test)
            at = at[(sig[at] != sig[k]).sum(axis=1) <= plan.most_errors]
            at = at[(keys[at] == keys[k]).argmax(axis=1) == mine]
            u.append(np.full(len(at), rep[k]))
            v.append(rep[at])
        return pa.record_batch({"u": np.concatenate(u), "v": np.concatenate(v)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held = None, []
        for batch in batches:
            key, i, j = (batch.column(c).to_numpy() for c in ("key", "i", "j"))
            plain = [batch.column(c).to_numpy() for c in ("block", "rep", "component", "n_shingles", "n_shared")]
            sig = _signatures(batch.column("signature"))
            cuts = np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            for a, b in zip([0, *cuts], [*cuts, len(key)]):
                if b == a:
                    continue
                if (key[a], i[a], j[a]) != tile and held:
                    yield pairs(tile[0], held)
                    held = []
                tile = (key[a], i[a], j[a])
                held.append((*(c[a:b] for c in plain), sig[a:b]))
        if held:
            yield pairs(tile[0], held)

    sorted_tiles = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return sorted_tiles.mapInArrow(run, "u long, v long").distinct()


def link(docs: DataFrame, percent: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    Documents are linked where 100 * intersection >= percent * union of their
    sets; a component is named by its smallest id.
    """
    plan = layout(percent)
    marks = scratch.durable(sketches(docs, text, key), "sketches")
    same = ["n_shingles", "set_a", "set_b"]
    classes = scratch.durable(
        marks.where("doc_id IS NOT NULL AND n_shingles > 0")
        .groupBy(*same)
        .agg(F.min("doc_id").alias("rep"), F.any_value("signature").alias("signature")),
        "classes",
    )
    met = scratch.durable(members(classes, plan), "members")
    stars = met.where("rep <> first").select(F.col("rep").alias("u"), F.col("first").alias("v")).distinct()
    bodies = scratch.durable(sets(docs, met.select("rep").distinct(), text, key), "sets")
    stars = scratch.durable(confirm(stars, bodies, percent), "links")
    joined = scratch.durable(components(stars), "components")

    grouped = (
        met.select("key", "rep")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("component", F.coalesce("component", "rep"))
    )
    mixed = grouped.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi")
    grouped = scratch.durable(grouped.join(mixed.select("key"), "key", "left_semi"), "mixed")
    shared = shared_sizes(bodies, grouped.select("rep").distinct())
    # A set whose shared shingles are fewer than its share is linked with none.
    known = classes.select("rep", "n_shingles", "signature").join(shared, "rep")
    known = known.where(100 * F.col("n_shared") >= percent * F.col("n_shingles"))
    rest = scratch.durable(_across(grouped.join(known, "rep"), plan), "pairs")
    more = confirm(rest, bodies, percent)
    merged = scratch.durable(components(stars.unionByName(more)), "components")

    named = classes.select(*same, "rep").join(merged.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select(*same, F.coalesce("component", "rep").alias("component_id"))
    out = marks.select("doc_id", *same).join(named, same, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
