"""Alignment of two tokenizers' ids over the same bytes, by divide and conquer at shared cuts.

A text is a space and the text itself, as the second tokenizer (B) puts a space
before it. It is cut before single spaces that part two characters other than
white space: no token of either tokenizer runs over such a place. The units
between are encoded and aligned once for each block of documents. Within a unit
the alignment is found by divide and conquer: a place near the middle where
tokens of both end is located by bisect, both halves follow, and intervals
without such a place are the leaf groups. All intervals of a level are handled
at once in numpy.

A link is a pair of overlapping token occurrences. How often two ids are linked
is counted over all documents: each block counts its pairs, the counts are
summed by one shuffle, and each block gets back the sums for its own pairs.
What else a block holds for that goes beside them as one packed piece of bytes,
cut into rows of a few kilobytes: no row, no batch between the JVM and Python
and no list on the JVM's heap grows with a block, and a task holds one block.

Texts that are null or empty, or whose tokens' bytes are not the text's, have
no tokens: their numbers are 0 and their groups empty. Repeated rows count
again, rows of null key are like others, other columns are not read. An empty
table gives no rows. Texts are read whole; a long one is cut at the same places.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketlane import scratch, settings
from marketlane.llm import blocks

A_FILE = "/opt/tokenizers/byte_bpe_50k.json"
B_FILE = "/opt/tokenizers/piece_bpe_32k.model"
_CUT = re.compile(r"(?<=\S) (?=\S)")
# Units that are aligned together, and that are encoded as one text.
UNITS = 20_000
RUN = 64
# Bytes of a block in one row, and rows in one batch that a task gives back.
PIECE = 4 << 10
PIECES = 256
# Bytes of text in a batch that a task gets, and of a row group of what is kept between.
BATCH_BYTES = 2 << 20
GROUP_BYTES = 16 << 20


@dataclass(frozen=True)
class Files:
    """Contents of both tokenizers' files, read where the query is built."""

    a: str
    b: bytes


def read(a: str = A_FILE, b: str = B_FILE) -> Files:
    return Files(Path(a).read_text(encoding="utf-8"), Path(b).read_bytes())


def _byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level entry stands for: printable ones themselves, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pair:
    """Both tokenizers, with the bytes and the printed id of every token."""

    def __init__(self, files: Files) -> None:
        self.files = files
        self.a = Tokenizer.from_str(files.a)
        self.a.encode_special_tokens = True
        letters = _byte_letters()
        special = {i for i, t in self.a.get_added_tokens_decoder().items() if t.special}
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for entry, i in self.a.get_vocab().items():
            if i not in special:
                self.a_bytes[i] = bytes(letters[x] for x in entry)
        self.b = sentencepiece.SentencePieceProcessor(model_proto=files.b)
        n = self.b.get_piece_size()
        pieces = [self.b.id_to_piece(i) for i in range(n)]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece of this model runs over a word's start")
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else b"" if self.b.is_control(i) or self.b.is_unknown(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.names = [str(i) for i in range(max(len(self.a_bytes), n))]


_pair: list[Pair] = []


def pair(files: Files) -> Pair:
    """The tokenizers of a worker process, made once."""
    if not _pair or _pair[0].files != files:
        _pair[:] = [Pair(files)]
    return _pair[0]


def units(text: str) -> list[str]:
    """The text behind a space, cut where both tokenizers surely cut; each unit begins with a space."""
    return [" " + u for u in _CUT.split(text)]


def _ragged(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each run its row, and the numbers from ``first`` on, ``count`` of them."""
    row = np.repeat(np.arange(len(first)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]


def _middle_cuts(a: np.ndarray, b: np.ndarray, ivs: np.ndarray) -> np.ndarray:
    """For each interval the place in ``a`` of a shared end nearest its middle, -1 where it has none.

    Rows of ``ivs`` are bounds of tokens in a and in b. The search goes outward
    from the middle by windows of doubled width, each probed in b by bisect.
    """
    a_lo, a_hi, b_lo, b_hi = ivs.T
    start = np.where(a_lo > 0, a[a_lo - 1], 0)
    mid = np.clip(np.searchsorted(a, (start + a[a_hi - 1]) // 2), a_lo, np.maximum(a_hi - 2, a_lo))
    found = np.full(len(ivs), -1, np.int64)
    open_, reach = np.arange(len(ivs)), 0
    while len(open_):
        width = max(1, reach)
        m, lo, hi = mid[open_], a_lo[open_], a_hi[open_] - 1
        right = np.minimum(m + reach, hi), np.minimum(m + reach + width, hi)
        left = np.maximum(m - reach - width + 1, lo), np.maximum(m - reach + 1, lo)
        row, at = _ragged(np.concatenate([left[0], right[0]]), np.concatenate([left[1] - left[0] if reach else 0 * m, right[1] - right[0]]))
        row %= len(open_)
        j = np.searchsorted(b, a[at])
        own = open_[row]
        shared = (j >= b_lo[own]) & (j < b_hi[own] - 1)
        shared[shared] = b[j[shared]] == a[at[shared]]
        row, at = row[shared], at[shared]
        near = np.lexsort((np.abs(at - m[row]), row))
        row, at = row[near], at[near]
        first = np.flatnonzero(np.diff(row, prepend=-1))
        found[open_[row[first]]] = at[first]
        reach += width
        left_over = np.ones(len(open_), bool)
        left_over[row] = False
        left_over &= (m - reach >= lo) | (m + reach < hi)
        open_ = open_[left_over]
    return found


def leaves(a: np.ndarray, b: np.ndarray, ivs: np.ndarray) -> np.ndarray:
    """Leaf groups, rows (first and end token of a, first and end token of b), in order of the text.

    ``a`` and ``b`` are the rising byte ends of both sides' tokens; ``ivs`` the
    intervals to start from, which both sides begin and end together.
    """
    done = []
    while len(ivs):
        single = (ivs[:, 1] - ivs[:, 0] == 1) | (ivs[:, 3] - ivs[:, 2] == 1)
        done.append(ivs[single])
        ivs = ivs[~single]
        if not len(ivs):
            break
        cut = _middle_cuts(a, b, ivs)
        done.append(ivs[cut < 0])
        ivs, cut = ivs[cut >= 0], cut[cut >= 0]
        at = np.searchsorted(b, a[cut]) + 1
        low, high = ivs.copy(), ivs.copy()
        low[:, 1], low[:, 3] = cut + 1, at
        high[:, 0], high[:, 2] = cut + 1, at
        ivs = np.concatenate([low, high])
    out = np.concatenate(done) if done else np.zeros((0, 4), np.int64)
    return out[np.argsort(out[:, 0])]


@dataclass
class Aligned:
    """Units of a block: tokens, links and printed groups of each."""

    ok: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    keys: np.ndarray  # the pairs linked, rising: a's id times b's number of ids plus b's id
    links: np.ndarray  # places in ``keys``, one unit after the other
    groups: list[str]


def _bounds(count: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(count, dtype=np.int64)])


def _narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers, none below 0, in as few bytes as hold them."""
    return values.astype(np.min_scalar_type(values.max(initial=0)))


def _runs(texts: list[str]) -> list[tuple[int, int]]:
    """Bounds of the units that are encoded as one text: runs of those that begin and end with a word, and single others."""
    out, start = [], 0
    for k, t in enumerate(texts):
        whole = not (t[1:2].isspace() or t[-1:].isspace())
        if not whole or k - start == RUN:
            if start < k:
                out.append((start, k))
            start = k
        if not whole:
            out.append((k, k + 1))
            start = k + 1
    if start < len(texts):
        out.append((start, len(texts)))
    return out


def _encoded(p: Pair, texts: list[str]) -> tuple[np.ndarray, tuple, tuple]:
    """Which units' bytes agree, and of those, for each side, all ids and how many each unit has.

    A run whose bytes do not agree is encoded again, unit by unit.
    """
    ok = np.zeros(len(texts), bool)
    ids: list[dict[int, list[int]]] = [{}, {}]
    counts = np.zeros((2, len(texts)), np.int64)
    open_ = _runs(texts)
    while open_:
        again = []
        whole = ["".join(texts[i:j]) for i, j in open_]
        a_ids = [e.ids for e in p.a.encode_batch_fast(whole, add_special_tokens=False)]
        b_ids = p.b.encode([t[1:] for t in whole], num_threads=1)
        for (i, j), text, *sides in zip(open_, whole, a_ids, b_ids):
            raw = text.encode()
            ends = np.cumsum([len(t.encode()) for t in texts[i:j]])
            found = []
            for mine, table, size in zip(sides, (p.a_bytes, p.b_bytes), (p.a_size, p.b_size)):
                if b"".join([table[x] for x in mine]) == raw:
                    at = np.cumsum(size[mine])
                    last = np.searchsorted(at, ends)
                    if np.array_equal(at[last], ends):
                        found.append(np.diff(last, prepend=-1))
            if len(found) == 2:
                ok[i:j] = True
                counts[:, i:j] = found
                ids[0][i], ids[1][i] = sides
            elif j - i > 1:
                again += [(k, k + 1) for k in range(i, j)]
        open_ = again
    flat = [np.fromiter(chain.from_iterable(held[k] for k in sorted(held)), np.int64) for held in ids]
    return ok, *zip(flat, counts[:, ok])


def align_units(p: Pair, texts: list[str]) -> Aligned:
    ok, (a, a_count), (b, b_count) = _encoded(p, texts)
    good = np.flatnonzero(ok)
    a_ends, b_ends = np.cumsum(p.a_size[a]), np.cumsum(p.b_size[b])
    a_at, b_at = _bounds(a_count), _bounds(b_count)
    leaf = leaves(a_ends, b_ends, np.stack([a_at[:-1], a_at[1:], b_at[:-1], b_at[1:]], 1))
    unit = np.searchsorted(a_at, leaf[:, 0], "right") - 1
    # Every token of b that overlaps a token of a.
    first = np.searchsorted(b_ends, a_ends - p.a_size[a], "right")
    row, at = _ragged(first, np.searchsorted(b_ends, a_ends, "left") - first + 1)
    out = [np.zeros(len(texts), np.int64) for _ in range(4)]
    link_unit = np.repeat(np.arange(len(good)), a_count)[row]
    for held, n in zip(out, (a_count, b_count, np.bincount(unit, minlength=len(good)), np.bincount(link_unit, minlength=len(good)))):
        held[good] = n
    a_names, b_names = ([p.names[i] for i in ids.tolist()] for ids in (a, b))
    printed = [
        (a_names[i] if j - i == 1 else ",".join(a_names[i:j])) + "|" + (b_names[k] if m - k == 1 else ",".join(b_names[k:m]))
        for i, j, k, m in leaf.tolist()
    ]
    groups = [""] * len(texts)
    edge = np.searchsorted(unit, np.arange(len(good) + 1)).tolist()
    for n, k in enumerate(good.tolist()):
        groups[k] = ";".join(printed[edge[n] : edge[n + 1]])
    keys, links = np.unique(a[row] * len(p.b_bytes) + b[at], return_inverse=True)
    return Aligned(ok, *out, keys, _narrow(links), groups)


def _joined(parts: list[Aligned]) -> Aligned:
    if len(parts) == 1:
        return parts[0]
    arrays = [np.concatenate([getattr(x, f) for x in parts]) for f in ("ok", "n_a", "n_b", "n_groups", "n_links")]
    keys, place = np.unique(np.concatenate([x.keys for x in parts]), return_inverse=True)
    place = np.split(_narrow(place), np.cumsum([len(x.keys) for x in parts])[:-1])
    links = np.concatenate([mine[x.links] for mine, x in zip(place, parts)])
    return Aligned(*arrays, keys, links, [g for x in parts for g in x.groups])


def _sum_by(values: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Sums of runs of ``values``."""
    total = np.concatenate([[0], np.cumsum(values)])
    return np.diff(total[_bounds(count)])


def _counted(links: np.ndarray, n_links: np.ndarray, occurs: np.ndarray, n: int) -> np.ndarray:
    """How often each of ``n`` pairs is linked, where each unit's links count as often as the unit occurs."""
    out = np.zeros(n, np.int64)
    edge = _bounds(n_links)
    for k in range(0, len(n_links), UNITS):
        mine = links[edge[k] : edge[min(k + UNITS, len(n_links))]]
        np.add.at(out, mine, np.repeat(occurs[k : k + UNITS], n_links[k : k + UNITS]))
    return out


def _whole(p: Pair, held: list[pa.RecordBatch], listing: Callable[[str], str]) -> tuple[np.ndarray, np.ndarray, pa.Buffer]:
    """A block's pairs, how often they are linked, and packed what its documents and units hold."""
    known: dict[str, int] = {}
    unit = []
    for batch in held:
        for at in range(0, len(batch), blocks.ROWS):
            for text in batch.column(1).slice(at, blocks.ROWS).to_pylist():
                unit.append(np.array([known.setdefault(u, len(known)) for u in units(text)] if text else [], np.int32))
    names = list(known)
    del known
    every = _joined([align_units(p, names[k : k + UNITS]) for k in range(0, len(names), UNITS)] or [align_units(p, [])])
    del names
    figures: list[list[int]] = [[] for _ in range(4)]
    times, sizes, groups = [], [], []
    for k, mine in enumerate(unit):
        if not every.ok[mine].all():
            mine = mine[:0]
        for out, held_in in zip(figures, (every.n_a, every.n_b, every.n_groups, every.n_links)):
            out.append(int(held_in[mine].sum()))
        groups.append(listing(";".join([every.groups[u] for u in mine.tolist()])) if len(mine) else "")
        unit[k], n = np.unique(mine, return_counts=True)
        times.append(_narrow(n))
        sizes.append(len(n))
    every.groups.clear()
    flat, n = np.concatenate(unit), np.concatenate(times)
    del unit, times
    occurs = np.bincount(flat, n, len(every.ok)).astype(np.int64)
    counts = _counted(every.links, every.n_links, occurs, len(every.keys))
    one = {
        "rows": pa.concat_arrays([x.column(0) for x in held]),
        **{c: pa.array(f, pa.int64()) for c, f in zip(("n_a", "n_b", "n_groups", "n_links"), figures)},
        "groups": pa.array(groups, pa.string()),
        "unit": pa.array(_narrow(flat)),
        "times": pa.array(n),
        "units": pa.array(sizes, pa.int32()),
        "pair": pa.array(every.links),
        "pairs": pa.array(_narrow(every.n_links)),
    }
    return every.keys, counts, _packed(pa.record_batch({c: _list(x) for c, x in one.items()}))


def _packed(batch: pa.RecordBatch) -> pa.Buffer:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd", use_threads=False)) as out:
        out.write_batch(batch)
    return sink.getvalue()


def _unpacked(data: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(data, options=pa.ipc.IpcReadOptions(use_threads=False)).read_next_batch()


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
_HELD = "block long, pos int, key long, n long, data binary"


def _held(block: int, start: int, n: int, key: pa.Array | None = None, count: pa.Array | None = None, data: pa.Array | None = None) -> pa.RecordBatch:
    """``n`` rows of a block from place ``start`` on: pairs and counts, or pieces of what else it holds."""
    columns = {"block": pa.array(np.full(n, block)), "pos": pa.array(np.arange(start, start + n, dtype=np.int32))}
    for name, kind, values in (("key", pa.int64(), key), ("n", pa.int64(), count), ("data", pa.binary(), data)):
        columns[name] = pa.nulls(n, kind) if values is None else values
    return pa.record_batch(columns)


def _pieces(data: pa.Buffer) -> Iterator[tuple[int, pa.Array]]:
    """The bytes in rows of ``PIECE`` bytes, batch by batch, each with the number of its first row."""
    for start in range(0, data.size, PIECE * PIECES):
        part = data.slice(start, min(PIECE * PIECES, data.size - start))
        edge = np.append(np.arange(0, part.size, PIECE), part.size).astype(np.int32)
        yield start // PIECE, pa.Array.from_buffers(pa.binary(), len(edge) - 1, [None, pa.py_buffer(edge), part])


def _blocks(docs: DataFrame, files: Files, listing: Callable[[str], str], block_bytes: int) -> DataFrame:
    """Rows of each block: its pairs with counts, and pieces of what its documents and units hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        p = pair(files)
        for block, held in blocks.gathered(batches, block_bytes):
            keys, counts, data = _whole(p, held, listing)
            del held
            blocks.freed()
            step = PIECE * PIECES // 32
            for at in range(0, len(keys), step):
                key, n = (pa.array(x[at : at + step]) for x in (keys, counts))
                yield _held(block, at, len(key), key, n)
            for at, piece in _pieces(data):
                yield _held(block, at, len(piece), data=piece)
            del keys, counts, data

    return docs.mapInArrow(run, _HELD)


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each block, which follow each other; a block may be spread over batches."""
    held: list[pa.RecordBatch] = []
    mine = None
    for batch in batches:
        block = batch.column("block").to_numpy()
        edge = [*np.flatnonzero(np.diff(block, prepend=block[:1] - 1)).tolist(), len(batch)]
        for start, end in zip(edge, edge[1:]):
            if held and block[start] != mine:
                yield pa.Table.from_batches(held)
                held = []
            mine = block[start]
            held.append(batch.slice(start, end - start))
        del batch
    if held:
        yield pa.Table.from_batches(held)


def _list(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _rated(rows: pa.Table) -> pa.RecordBatch:
    """Documents of a block, from its pieces and what is found for its pairs."""
    piece = pc.is_valid(rows["data"])
    pieces = rows.filter(piece).select(["pos", "data"]).sort_by("pos")
    found = rows.filter(pc.invert(piece))
    block = _unpacked(b"".join(pieces["data"].to_pylist()))
    held = {c: x.values for c, x in zip(block.schema.names, block.columns)}
    unit, times, sizes, place, count = (held[c].to_numpy() for c in ("unit", "times", "units", "pair", "pairs"))
    pos = found["pos"].to_numpy()
    sums = {}
    for name, column in (("n_best", "best"), ("count_sum", "total")):
        per_pair = np.zeros(len(pos), np.int64)
        per_pair[pos] = found[column].to_numpy()
        sums[name] = pa.array(_sum_by(_sum_by(per_pair[place], count)[unit] * times, sizes))
    return pa.record_batch({"id": held["rows"], **{c: held[c] for c in _NUMBERS}, **sums, "groups": held["groups"]})


def align(
    docs: DataFrame,
    files: Files,
    text: str = "text",
    key: str = "doc_id",
    listing: Callable[[str], str] = str,
    block_bytes: int = blocks.BLOCK_BYTES,
) -> DataFrame:
    """For each row of ``docs``: key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    groups lists the groups in order, ``a1,a2|b1;a3|b2,b3``, as ``listing``
    turns it (run in tasks, say to a digest). n_best is the number of links whose
    pair occurs as often as any pair of its B id, over all documents; count_sum
    adds up how often each link's pair occurs.
    """
    kind = docs.schema[key].dataType.simpleString()
    with settings.held(docs.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES)):
        held = scratch.durable(_blocks(docs.select(key, text), files, listing, block_bytes), "aligned", {"parquet.block.size": str(GROUP_BYTES)})
    n_b = len(pair(files).b_bytes)
    pairs = blocks.totals(held.where(F.col("data").isNull()).drop("data")).withColumn("b", F.col("key") % n_b)
    # One row for each id of B at most, whatever the data.
    most = pairs.groupBy("b").agg(F.max("total").alias("most"))
    best = F.col("total") == F.col("most")
    found = pairs.join(F.broadcast(most), "b").select("block", "pos", "total", best.alias("best"), F.lit(None).cast("binary").alias("data"))
    pieces = held.where(F.col("data").isNotNull())
    pieces = pieces.select("block", "pos", F.lit(None).cast("long").alias("total"), F.lit(None).cast("boolean").alias("best"), "data")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_block(batches):
            out = _rated(rows)
            del rows
            for at in range(0, len(out), blocks.ROWS):
                yield out.slice(at, blocks.ROWS)
            del out
            blocks.freed()

    fields = f"id {kind}, " + ", ".join(f"{c} long" for c in (*_NUMBERS, "n_best", "count_sum")) + ", groups string"
    out = pieces.union(found).repartition("block").sortWithinPartitions("block").mapInArrow(run, fields)
    return out.withColumnRenamed("id", key)
