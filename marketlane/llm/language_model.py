"""Log-likelihood of documents under a gated recurrent language model of the corpus.

A text's tokens are its words, runs without white space [\\x20\\x09-\\x0D] with
A-Z lower-cased, and one end. Counts of all tokens of the documents to learn
from are taken over the whole corpus and looked up for every block of
documents (``blocks``). The ``HEADS`` most frequent tokens are predicted one by
one; a rarer one by the class of its spelling (its first two characters), by
its turns in that class's tree to one of ``2 ** DEPTH`` leaves, to which it is
hashed, and by its share of the leaf; those seen once, and all unseen tokens as one, by the
class of new tokens, in which unseen ones have the share that the numbers of
words seen once and twice suggest (Good and Turing). So the model spreads all
probability over the known tokens and one unseen token, as the base score does.

The network (``recurrent``) is trained on every document to learn from, once:
in ``ROUNDS`` rounds, each over another part of all blocks, every task carries
the last model through its blocks, and the models are averaged by the tokens
they learnt from. What the driver holds is one model and ``HEADS`` words.
A document is scored whole, its state carried from window to window.

Null and empty texts are just an end; repeated rows count again; rows of null
key are like others; other columns are not read; an empty table gives no rows.
Without documents to learn from all tokens are unseen.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlane import scratch
from marketlane.llm import blocks, recurrent

HEADS = 256
# Of the tree of each spelling: 16 * 512 leaves for the words below the heads that were seen more than once.
DEPTH = 9
SHAPE = recurrent.Shape(heads=HEADS, width=32, spellings=16, depth=DEPTH)
ROUNDS = 3
END = ""
ADDED = 0.1
# Parts in which models are averaged.
PARTS = 16


@dataclass(frozen=True)
class Counts:
    tokens: int
    distinct: int
    once: int
    twice: int
    heads: dict[str, int]  # word to count, most frequent first, the end before all
    spellings: tuple[int, ...]  # tokens of words below the heads that were seen more than once
    leaves: tuple[int, ...] = ()  # the same by spelling and leaf

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + ADDED) / (self.tokens + ADDED * (self.distinct + 1)))

    def share(self, counts: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """log10 of a token's share of its code: its leaf or class of spelling, or the new tokens."""
        out = np.zeros(len(counts))
        leaf = codes >= SHAPE.first_leaf
        out[leaf] = np.log10(counts[leaf] / np.array(self.leaves)[codes[leaf] - SHAPE.first_leaf]) if leaf.any() else 0
        new = (codes >= HEADS + SHAPE.spellings) & ~leaf
        rare = (codes >= HEADS) & (codes < HEADS + SHAPE.spellings)
        out[rare] = np.log10(counts[rare] / np.array(self.spellings)[codes[rare] - HEADS])
        unseen = (self.once + 1) / (self.once + 2 * self.twice + 2) if self.once else 1.0
        out[new & (counts == 0)] = math.log10(unseen)
        if self.once:
            once = new & (counts > 0)
            out[once] = math.log10((1 - unseen) / self.once)
        return out

    def start(self) -> recurrent.Model:
        leaves = np.array(self.leaves, float) if self.leaves else None
        return recurrent.start(SHAPE, np.array(list(self.heads.values()), float), np.array(self.spellings, float), self.once + 1, leaves)


def _spelling(word: str) -> int:
    return zlib.crc32(word[:2].encode()) % SHAPE.spellings


def _list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _binary(values: np.ndarray, kind: str) -> pa.Array:
    return pa.array([values.astype(kind).tobytes()], pa.binary())


class _Numbered(dict):
    """Words to their numbers, in the order in which they are first looked up."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """A row for each block: its words with their counts in documents to learn from, and each document's words."""
    kind = docs.schema[docs.columns[0]].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, held in blocks.gathered(batches, block_bytes):
            known = _Numbered({END.encode(): 0})
            words, sizes = [], []
            for batch in held:
                for at in range(0, len(batch), blocks.ROWS):
                    for text in batch.column(1).slice(at, blocks.ROWS).cast(pa.binary()).to_pylist():
                        mine = (text or b"").lower().split()
                        mine.append(END.encode())
                        words.append(np.fromiter(map(known.__getitem__, mine), np.int32, len(mine)))
                        sizes.append(len(mine))
            learn = pa.concat_arrays([x.column(2) for x in held])
            seen = [w for w, yes in zip(words, learn.to_pylist()) if yes]
            counts = np.bincount(np.concatenate(seen) if seen else [], minlength=len(known)).astype(np.int64)
            yield pa.record_batch(
                {
                    "block": pa.array([block]),
                    "keys": _list(pa.array(list(known), pa.binary()).cast(pa.string())),
                    "counts": _list(pa.array(counts)),
                    "rows": _list(pa.concat_arrays([x.column(0) for x in held])),
                    "learn": _list(learn),
                    "words": _binary(np.concatenate(words), "<i4"),
                    "sizes": _list(pa.array(sizes, pa.int32())),
                }
            )

    fields = f"block long, keys array<string>, counts array<long>, rows array<{kind}>, learn array<boolean>, words binary, sizes array<int>"
    return docs.mapInArrow(run, fields)


def _counts(rows: DataFrame) -> Counts:
    """Corpus figures: two bounded results, one row for each leaf and HEADS words."""
    one = rows.where(F.col("first") & (F.col("total") > 0))
    total = F.col("total")
    figures = one.groupBy("leaf").agg(
        F.sum("total").alias("tokens"),
        F.count(F.lit(1)).alias("distinct"),
        F.count_if(total == 1).alias("once"),
        F.count_if(total == 2).alias("twice"),
        F.coalesce(F.sum(F.when(total > 1, total)), F.lit(0)).alias("often"),
    )
    parts = {r["leaf"]: r for r in figures.collect()}
    end = F.col("key") == END
    top = one.orderBy(end.desc(), total.desc(), "key").select("key", "total", "leaf").limit(HEADS).collect()
    heads = {END: 0} | {r["key"]: r["total"] for r in top}
    heads = dict(list(heads.items())[:HEADS])
    leaves = np.array([parts[k]["often"] if k in parts else 0 for k in range(SHAPE.spellings * SHAPE.leaves)], np.int64)
    for r in top:
        if r["key"] in heads and r["total"] > 1:
            leaves[r["leaf"]] -= r["total"]
    often = leaves.reshape(SHAPE.spellings, -1).sum(axis=1)
    sums = [sum(r[c] for r in parts.values()) for c in ("tokens", "distinct", "once", "twice")]
    return Counts(*sums, heads, tuple(often.tolist()), tuple(leaves.tolist()))


def _numbers(column: pa.Array, row: int) -> np.ndarray:
    return column[row].values.to_numpy(zero_copy_only=False)


def _coded(held: DataFrame, rows: DataFrame, counts: Counts) -> DataFrame:
    """Blocks with each document's codes, base score, the shares within codes, and number of known tokens."""
    spark = held.sparkSession
    kind = held.schema["rows"].dataType.simpleString()
    heads = spark.createDataFrame([(w, k) for k, w in enumerate(counts.heads)], "key string, head int")
    new = F.shiftright("leaf", DEPTH) + F.lit(HEADS + SHAPE.spellings)
    rare = F.when(F.col("total") > 1, F.col("leaf") + SHAPE.first_leaf).otherwise(new)
    found = rows.join(F.broadcast(heads), "key", "left").select("block", "pos", "total", F.coalesce("head", rare).cast("int").alias("code"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = {c: batch.column(c) for c in batch.schema.names}
            for k in range(len(batch)):
                back = row["found"][k].values
                pos, total, code = (back.field(c).to_numpy(zero_copy_only=False) for c in ("pos", "total", "code"))
                per_key = np.empty((2, len(pos)), np.int64)
                per_key[:, pos] = total, code
                words = np.frombuffer(row["words"][k].as_py(), "<i4")
                starts = np.cumsum(_numbers(row["sizes"], k)) - _numbers(row["sizes"], k)
                base, share, known = (
                    np.add.reduceat(x[words], starts) for x in (counts.base(per_key[0]), counts.share(*per_key), (per_key[0] > 0).astype(np.int64))
                )
                out = {c: row[c].slice(k, 1) for c in ("block", "rows", "learn", "sizes")}
                out |= {"codes": _binary(per_key[1][words], "<i2"), "base": _list(pa.array(base)), "share": _list(pa.array(share)), "known": _list(pa.array(known))}
                yield pa.record_batch(out)
        blocks.freed()

    fields = f"block long, rows {kind}, learn array<boolean>, sizes array<int>, codes binary, base array<double>, share array<double>, known array<long>"
    return blocks.returned(held, found, [F.col("total"), F.col("code")]).mapInArrow(run, fields)


def _documents(batch: pa.RecordBatch, k: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(batch.column("codes")[k].as_py(), "<i2"), _numbers(batch.column("sizes"), k).astype(np.int64)


def _round(coded: DataFrame, model: np.ndarray, number: int) -> np.ndarray:
    """The model after a part of all documents: tasks' models, averaged by tokens."""
    size = -(-len(model) // PARTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, learnt = None, 0
        blocks.steady()
        for batch in batches:
            for k in range(len(batch)):
                codes, sizes = _documents(batch, k)
                mine = _numbers(batch.column("learn"), k).astype(bool)
                if mine.any():
                    net = net or recurrent.Network(SHAPE, recurrent.unpacked(model, SHAPE))
                    net.train(codes[np.repeat(mine, sizes)], sizes[mine])
                    learnt += int(sizes[mine].sum())
        if net:
            flat, task = recurrent.packed(net.m), TaskContext.get().partitionId()
            parts = [flat[at : at + size].tobytes() for at in range(0, len(flat), size)]
            n = len(parts)
            yield pa.record_batch({"part": pa.array(range(n), pa.int32()), "task": pa.array([task] * n), "learnt": pa.array([learnt] * n), "body": pa.array(parts, pa.binary())})

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        weight: dict[int, int] = {}
        for batch in batches:
            for part, learnt, body in zip(*(batch.column(c).to_pylist() for c in ("part", "learnt", "body"))):
                total[part] = total.get(part, 0) + np.frombuffer(body, np.float32) * float(learnt)
                weight[part] = weight.get(part, 0) + learnt
        out = [(p, (v / weight[p]).astype(np.float32).tobytes()) for p, v in sorted(total.items())]
        yield pa.record_batch({"part": pa.array([p for p, _ in out], pa.int32()), "body": pa.array([b for _, b in out], pa.binary())})

    part = coded.where(F.pmod(F.xxhash64("block"), F.lit(ROUNDS)) == number)
    learnt = part.select("learn", "sizes", "codes").mapInArrow(run, "part int, task long, learnt long, body binary")
    dealt = learnt.repartition(PARTS, "part").sortWithinPartitions("part", "task")
    bodies = {r["part"]: r["body"] for r in dealt.mapInArrow(mean, "part int, body binary").collect()}
    return np.frombuffer(b"".join(bytes(bodies[p]) for p in sorted(bodies)), np.float32) if bodies else model


def _scored(coded: DataFrame, model: np.ndarray) -> DataFrame:
    kind = coded.schema["rows"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = recurrent.Network(SHAPE, recurrent.unpacked(model, SHAPE))
        blocks.steady()
        for batch in batches:
            for k in range(len(batch)):
                codes, sizes = _documents(batch, k)
                score = net.score(codes, sizes) / math.log(10) + _numbers(batch.column("share"), k)
                yield pa.record_batch(
                    {
                        "id": batch.column("rows")[k].values,
                        "n_tokens": pa.array(sizes),
                        "n_known": batch.column("known")[k].values,
                        "base_score": batch.column("base")[k].values,
                        "score": pa.array(score),
                    }
                )

    return coded.mapInArrow(run, f"id {kind}, n_tokens long, n_known long, base_score double, score double")


def score(docs: DataFrame, learn: Column, text: str = "text", key: str = "doc_id", block_bytes: int = blocks.BLOCK_BYTES) -> DataFrame:
    """For each row of ``docs``: key, n_tokens, n_known, train_tokens, base_score, score (log10 of its probability).

    Documents for which ``learn`` holds are learnt from; null counts as false.
    n_known is the number of tokens that those have.
    """
    wanted = docs.select(F.col(key), F.col(text), F.coalesce(learn, F.lit(False)))
    held = scratch.durable(_blocks(wanted.toDF("id", "text", "learn"), block_bytes), "lm-blocks")
    spelling = F.pmod(F.crc32(F.substring("key", 1, 2).cast("binary")), F.lit(SHAPE.spellings)).cast("int")
    leaf = F.shiftleft(spelling, DEPTH) + F.pmod(F.xxhash64("key"), F.lit(SHAPE.leaves)).cast("int")
    rows = blocks.summed(held).select("block", "pos", "key", "total", "first", leaf.alias("leaf"))
    with scratch.held(rows, "lm-words") as rows:
        counts = _counts(rows)
        coded = scratch.durable(_coded(held, rows, counts), "lm-codes")
    model = recurrent.packed(counts.start())
    for number in range(ROUNDS):
        model = _round(coded, model, number)
    out = _scored(coded, model).withColumn("train_tokens", F.lit(counts.tokens).cast("long"))
    return out.select(F.col("id").alias(key), "n_tokens", "n_known", "train_tokens", "base_score", "score")
