"""Blocks of whole documents, and looking up corpus-wide sums for what a block holds.

A block is what a task reads next of its partition, up to a number of bytes;
a longer document is a block of its own. Each block names its distinct keys
once, with their counts, so a key that stands in every document is one row per
block, and what comes back to a block is bounded by the block.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BYTES = 8 << 20
# Rows of a batch that are turned into Python objects at once.
ROWS = 512

try:
    _libc = ctypes.CDLL("libc.so.6")
except OSError:  # a system without glibc
    _libc = None


def gathered(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Runs of rows (any columns, of which the second is a text) with the block's number."""
    place = TaskContext.get()
    base = (place.partitionId() if place else 0) << 32
    held, size, number = [], 0, 0
    for batch in batches:
        start = 0
        for at in range(0, len(batch), ROWS):
            part = batch.slice(at, ROWS)
            weight = part.column(1).nbytes
            if size and size + weight > limit:
                if at > start:
                    held.append(batch.slice(start, at - start))
                yield base + number, held
                held, size, number, start = [], 0, number + 1, at
                freed()
            size += weight
        if len(batch) > start:
            held.append(batch.slice(start))
    if held:
        yield base + number, held
        held = []
        freed()


def steady() -> None:
    """Let the process keep a few freed megabytes, so that arrays made again and again are not mapped anew each time."""
    if _libc is not None:
        _libc.mallopt(-1, 32 << 20)  # M_TRIM_THRESHOLD
        _libc.mallopt(-3, 16 << 20)  # M_MMAP_THRESHOLD


def freed() -> None:
    """Give what the last block held back to the system; a worker process serves many tasks."""
    pa.default_memory_pool().release_unused()
    if _libc is not None:
        _libc.malloc_trim(0)


def summed(blocks: DataFrame) -> DataFrame:
    """block, pos, key, n, the sum of n over all blocks, and whether the block is the key's first.

    Blocks have arrays ``keys`` and ``counts``. One shuffle by key; a key has a row per block at most.
    """
    each = blocks.select("block", F.posexplode(F.arrays_zip("keys", "counts")).alias("pos", "held"))
    return totals(each.select("block", "pos", F.col("held.keys").alias("key"), F.col("held.counts").alias("n")))


def totals(rows: DataFrame) -> DataFrame:
    """``summed`` for rows of block, pos, key and n."""
    line = Window.partitionBy("key").orderBy("block")
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.withColumns({"total": F.sum("n").over(whole), "first": F.row_number().over(line) == 1})


def returned(blocks: DataFrame, rows: DataFrame, columns: list[Column], drop: tuple[str, ...] = ("keys", "counts")) -> DataFrame:
    """``blocks`` with the column ``found``: what ``rows`` hold for each, structs that begin with pos, in any order."""
    found = rows.groupBy("block").agg(F.collect_list(F.struct("pos", *columns)).alias("found"))
    return blocks.drop(*drop).join(found, "block", "left")


