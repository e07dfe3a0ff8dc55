"""Benchmark passages in training documents: seeds that no match can do without, then Smith-Waterman alignment.

Words are runs of letters and digits with A-Z lower-cased (bytes above ASCII
count as letters). MATCH for equal words, MISMATCH for different ones, GAP for
one left out: the best local score over that of the whole item is the pair's
score; copies get 1, edited ones less. All pairs of ``score`` or more are found.

Which pairs are aligned follows from the score alone. An alignment of m equal
words and e errors has 2 m - e >= 2 score L for an item of L words, so it lies
within (3 - 2 score) L words of the document, and for any number M either at
least M of the item's words are equal or at least 2 score L - M of its pairs of
neighbours are. Of things of which ``need`` of ``total`` must be there, any
choice of total - need + t holds t that are: the ones that occur least in all
documents are taken, which saves work and loses nothing, however common they
are. Where t different places of a document have such seeds of an item near
enough to each other, and the words round them that the item has could make up
the score, they are aligned. An item of at most WHOLE_WORDS words must stand
whole.

Items are taken in blocks of at most BLOCK_WORDS words, each sent to all tasks,
so what is sent is bounded however many items there are; documents are read
whole and are never shuffled. Null, empty and wordless texts and items match
nothing. An item given twice under one id counts once, by its largest score.
Repeated documents give repeated rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlane.llm import wordhash

WHOLE_WORDS = 3
TOGETHER = 3  # seeds of an item that must stand near each other, where it has as many
MATCH, MISMATCH, GAP = 2, -1, -1
SCORE = 0.5
BLOCK_WORDS = 1_000_000
HITS = 1 << 21  # taken at once
_BITS = 20


@dataclass(frozen=True)
class Block:
    """Items with their words."""

    ids: np.ndarray
    words: list[np.ndarray]


@dataclass(frozen=True)
class Seeds:
    """Runs of ``n`` words by hash with their items, and how many of an item's must stand together."""

    n: int
    hashes: np.ndarray
    items: np.ndarray
    together: np.ndarray


def _block(rows: list) -> Block:
    ids, words = [], []
    for r in rows:
        h, _ = wordhash.words([(r["text"] or "").encode()], wordhash.ALNUM)
        if len(h):
            ids.append(r["item_id"])
            words.append(h)
    return Block(np.array(ids, np.int64), words)


def blocks(items: DataFrame) -> Iterator[Block]:
    """Items in blocks of about BLOCK_WORDS words, cut by a hash of their ids."""
    rows = items.where("item_id IS NOT NULL AND text IS NOT NULL").select(F.col("item_id").cast("long"), "text")
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = 1 + total // (4 * BLOCK_WORDS)
    for k in range(n):
        yield _block(rows.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k).collect())


def _map(hashes: np.ndarray) -> np.ndarray:
    """The low bits of the hashes that occur: a cheap first look."""
    out = np.zeros(1 << _BITS, bool)
    out[hashes & np.uint64((1 << _BITS) - 1)] = True
    return out


def _found(grams: np.ndarray, hashes: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose run is among the sorted distinct ``hashes``, and which it is."""
    at = np.flatnonzero(low[grams & np.uint64((1 << _BITS) - 1)])
    if not len(hashes):
        return at[:0], at[:0]
    which = np.minimum(np.searchsorted(hashes, grams[at]), len(hashes) - 1)
    same = hashes[which] == grams[at]
    return at[same], which[same]


def frequencies(docs: DataFrame, block: Block, text: str = "text") -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For words and pairs of neighbours of the block: sorted hashes, and how often they occur in all documents."""
    runs = {n: np.unique(np.concatenate([np.zeros(0, np.uint64), *(wordhash.grams(w, n) for w in block.words)])) for n in (1, 2)}
    maps = {n: _map(h) for n, h in runs.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = {n: np.zeros(len(h), np.int64) for n, h in runs.items()}
        for batch in batches:
            for _, held in wordhash.batches(batch.column(0).cast(pa.binary()).to_pylist()):
                hashes, _ = wordhash.words(held, wordhash.ALNUM)
                for n, h in runs.items():
                    # A run over the end of a text counts too; the counts only say what is looked for first.
                    counts[n] += np.bincount(_found(wordhash.grams(hashes, n), h, maps[n])[1], minlength=len(h))
        for n, c in counts.items():
            at = np.flatnonzero(c)
            yield pa.record_batch({"n": np.full(len(at), n, np.int32), "row": at, "found": c[at]})

    each = docs.select(text).mapInArrow(run, "n int, row long, found long")
    sums = each.groupBy("n", "row").agg(F.sum("found").alias("found")).toArrow()
    out = {}
    for n, h in runs.items():
        mine = sums.column("n").to_numpy() == n
        counts = np.zeros(len(h), np.int64)
        counts[sums.column("row").to_numpy()[mine]] = sums.column("found").to_numpy()[mine]
        out[n] = h, counts
    return out


def needs(length: int, score: float) -> dict[int, int]:
    """How many words (1), or else how many pairs of neighbours (2), a match of ``score`` shares with the item at least."""
    total = math.ceil(MATCH * score * length - 1e-9)
    words = min(math.ceil(0.75 * MATCH * score * length), length + 1)
    if total - words < 1:
        return {1: max(1, math.ceil(total / MATCH))}
    return {1: words, 2: total - words} if words <= length else {2: total - words}


def seeds(block: Block, counts: dict[int, tuple[np.ndarray, np.ndarray]], score: float = SCORE) -> list[Seeds]:
    """The rarest runs of each item that a match must have TOGETHER of, or as many as it needs."""
    found: dict[int, list] = {1: [], 2: []}
    together = {n: np.ones(len(block.ids), np.int64) for n in found}
    for i, words in enumerate(block.words):
        wanted = {min(2, len(words)): 1} if len(words) <= WHOLE_WORDS else needs(len(words), score)
        for n, need in wanted.items():
            g = wordhash.grams(words, n)
            t = together[n][i] = min(TOGETHER, need)
            hashes, often = counts[n]
            order = np.argsort(often[np.searchsorted(hashes, g)], kind="stable")
            kept = np.unique(g[order[: len(g) - need + t]])
            found[n].append((kept, np.full(len(kept), i)))
    out = []
    for n, parts in found.items():
        if parts:
            h, i = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(h, kind="stable")
            out.append(Seeds(n, h[order], i[order], together[n]))
    return out


def align(item: np.ndarray, part: np.ndarray) -> tuple[float, int, int]:
    """Best local score over that of the whole item, and the bounds of the aligned words of ``part``."""
    at = np.arange(len(part) + 1)
    slope = -GAP * at
    row, start = np.zeros(len(part) + 1), at.copy()
    best = (0.0, 0, 0)
    for word in item:
        diagonal = row[:-1] + np.where(part == word, MATCH, MISMATCH)
        above = row[1:] + GAP
        new = np.concatenate([[0.0], np.maximum(np.maximum(diagonal, above), 0)])
        origin = np.concatenate([[0], np.where(new[1:] <= 0, at[1:], np.where(diagonal >= above, start[:-1], start[1:]))])
        reach = np.maximum.accumulate(new + slope)
        source = np.maximum.accumulate(np.where(new + slope == reach, at, 0))
        row, start = reach - slope, origin[source]
        top = int(np.argmax(row))
        if row[top] > best[0]:
            best = (float(row[top]), int(start[top]), top)
    return best[0] / (MATCH * len(item)), best[1], best[2]


def _hits(hashes: np.ndarray, bounds: np.ndarray, s: Seeds, first: np.ndarray, low: np.ndarray):
    """Texts, items and places of the seeds, by text, item and place; some texts at a time."""
    distinct = s.hashes[first]
    at, which = _found(wordhash.grams(hashes, s.n), distinct, low)
    text = np.searchsorted(bounds, at, "right") - 1
    inside = at + s.n <= bounds[text + 1]
    at, which, text = at[inside], which[inside], text[inside]
    count = np.diff(np.append(first, len(s.hashes)))[which]
    sums = np.cumsum(count)
    a = 0
    while a < len(at):
        b = int(np.searchsorted(sums, (sums[a - 1] if a else 0) + HITS, "right"))
        if b < len(at):
            b = max(int(np.searchsorted(text, text[b])), int(np.searchsorted(text, text[a], "right")))
        c = count[a:b]
        row = np.repeat(first[which[a:b]] - (np.cumsum(c) - c), c) + np.arange(c.sum())
        doc, place, item = np.repeat(text[a:b], c), np.repeat(at[a:b], c), s.items[row]
        order = np.lexsort((place, item, doc))
        yield doc[order], item[order], place[order]
        a = b


def _matched(docs: DataFrame, block: Block, seeded: list[Seeds], score: float, text: str, key: str) -> DataFrame:
    length = np.array([len(w) for w in block.words], np.int64)
    reach = np.floor((1 + MATCH * (1 - score)) * length + 1e-9).astype(np.int64)
    firsts = [np.unique(s.hashes, return_index=True)[1] for s in seeded]
    maps = [_map(s.hashes) for s in seeded]
    vocabulary = [np.unique(w) for w in block.words]

    def parts(hashes, bounds):
        """Text, item, first and last seed of each stretch where enough seeds stand together."""
        for s, first, low in zip(seeded, firsts, maps):
            for doc, item, place in _hits(hashes, bounds, s, first, low):
                other = np.arange(len(doc)) + s.together[item] - 1
                ok = other < len(doc)
                a, b = np.flatnonzero(ok), other[ok]
                ok = (doc[a] == doc[b]) & (item[a] == item[b]) & (place[b] - place[a] <= reach[item[a]])
                a, b = a[ok], b[ok]
                yield doc[a], item[a], place[a], place[b]

    def one(hashes, item, firsts, lasts):
        """Best alignment of an item round the stretches found in one document."""
        words, known, far = block.words[item], vocabulary[item], reach[item]
        best = (0.0, 0, 0)
        lo, hi = np.maximum(firsts - far, 0), np.minimum(lasts + 1 + far, len(hashes))
        cuts = np.flatnonzero(lo[1:] > np.maximum.accumulate(hi)[:-1]) + 1
        for a, b in zip([0, *cuts], [*cuts, len(lo)]):
            start = int(lo[a])
            part = hashes[start : int(hi[a:b].max())]
            # Words that the item lacks cost, so the best sum of a stretch is no less than any alignment's score.
            held = known[np.minimum(np.searchsorted(known, part), len(known) - 1)] == part
            sums = np.concatenate([[0], np.cumsum(np.where(held, MATCH, MISMATCH))])
            if (sums - np.minimum.accumulate(sums)).max() < max(score, best[0]) * MATCH * len(words):
                continue
            got = align(words, part)
            if got[0] > best[0]:
                best = (got[0], start + got[1], start + got[2])
        return best

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for offset, held in wordhash.batches(batch.column(1).cast(pa.binary()).to_pylist()):
                hashes, bounds = wordhash.words(held, wordhash.ALNUM)
                near = list(parts(hashes, bounds))
                if not near:
                    continue
                doc, item, first, last = (np.concatenate(x) for x in zip(*near))
                order = np.lexsort((first, item, doc))
                doc, item, first, last = doc[order], item[order], first[order], last[order]
                cuts = np.flatnonzero((doc[1:] != doc[:-1]) | (item[1:] != item[:-1])) + 1
                for a, b in zip([0, *cuts], [*cuts, len(doc)]):
                    if b > a:
                        d, i = doc[a], item[a]
                        got = one(hashes[bounds[d] : bounds[d + 1]], i, first[a:b] - bounds[d], last[a:b] - bounds[d])
                        if got[0] >= (1 if length[i] <= WHOLE_WORDS else score):
                            out.append((offset + int(d), int(block.ids[i]), *got))
            at, item, value, start, end = zip(*out) if out else ((),) * 5
            yield pa.record_batch({
                "doc_id": batch.column(0).take(pa.array(at, pa.int32())), "item_id": pa.array(item, pa.int64()),
                "score": pa.array(value, pa.float64()), "first_word": pa.array(start, pa.int64()), "end_word": pa.array(end, pa.int64()),
            })

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"doc_id {kind}, item_id long, score double, first_word long, end_word long")


def matches(docs: DataFrame, items: DataFrame, score: float = SCORE, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, item_id, score, first_word and end_word for each document and item that align to ``score`` or more.

    ``first_word`` and ``end_word`` bound the document's aligned words.
    """
    found = []
    for block in blocks(items.groupBy("item_id", "text").agg(F.count(F.lit(1)).alias("n"))):
        found.append(_matched(docs, block, seeds(block, frequencies(docs, block, text), score), score, text, key))
    return reduce(DataFrame.unionByName, found)


def clean(docs: DataFrame, items: DataFrame, score: float = SCORE) -> DataFrame:
    """``docs`` without those that hold a test item; rows with a null id stay."""
    found = matches(docs, items, score).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)
