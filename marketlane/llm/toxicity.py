"""Toxicity: a linear classifier over character n-grams scaled by naive Bayes log-count ratios.

The n-grams of 3, 4 and 5 bytes of the lower-cased text, and the same with the
ends of the text marked, are hashed into 2**SLOT_BITS slots; a document has a
slot or has it not. For each slot the share of toxic and of other training
documents that have it gives the log-count ratio r. The slots whose ratio is
surest (by its standard error) are kept, a document's vector is r where it has
the slot and 0 elsewhere, and a regularised logistic regression on these
vectors gives the weights. A score adds up the weights of the slots that a text
has and takes the logistic function.

Training reads at most ``per_class`` labelled documents of either class (a
parameter); its counts are made by Spark and have at most 2**SLOT_BITS rows.
Scoring reads whole texts. An empty or null text has no slots and gets the
score of the intercept. With one class or no labelled rows, every score is the
share of toxic rows (0 without rows). Repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlane.llm import labelled

SLOT_BITS = 18
ORDERS = (3, 4, 5)
PER_CLASS = 4000
KEPT = 2000
# A slot's ratio counts as sure from so many standard errors on.
SURE = 4.0
RIDGE = 1e-3


def slots(text: str) -> np.ndarray:
    """The distinct slots of a text."""
    b = np.frombuffer(b"\x02" + text.lower().encode("utf-8", "replace") + b"\x03", np.uint8).astype(np.uint32)
    seen = np.zeros(1 << SLOT_BITS, bool)
    rolling = b
    for n in range(2, max(ORDERS) + 1):
        if len(rolling) < 2:
            break
        rolling = rolling[:-1] * np.uint32(0x01000193) ^ b[n - 1 :]
        if n in ORDERS and len(text):
            mixed = (rolling ^ (rolling >> np.uint32(15))) * np.uint32(0x9E3779B1)
            seen[mixed >> np.uint32(32 - SLOT_BITS)] = True
    return np.flatnonzero(seen).astype(np.int32)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    intercept: float

    def score(self, text: str | None) -> float:
        total = self.intercept + float(self.weights[slots(text or "")].sum())
        return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and intercept by accelerated gradient steps; either class counts by its share."""
    n, d = x.shape
    w = v = np.zeros(d + 1)
    # Lipschitz bound of the loss by a few power iterations.
    u = np.ones(d, x.dtype)
    for _ in range(20):
        u = x.T @ (x @ u)
        u /= max(np.linalg.norm(u), 1e-12)
    rate = 1 / (0.25 * (np.linalg.norm(x @ u) ** 2 / n + 1) + ridge)
    for k in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ v[:d].astype(x.dtype) + v[d], -500, 500)))
        g = np.append(x.T @ (p - y).astype(x.dtype) / n + ridge * v[:d], (p - y).mean())
        new = v - rate * g
        v = new + k / (k + 3) * (new - w)
        w = new
    return w[:d], float(w[d])


def _kept_slots(rows: DataFrame, kept: np.ndarray) -> DataFrame:
    """y and the kept slots that each training row has."""
    chosen = np.zeros(1 << SLOT_BITS, bool)
    chosen[kept] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s[chosen[s]].tolist() for s in map(slots, batch.column("text").to_pylist())]
            yield pa.record_batch({"y": batch.column("y"), "slots": pa.array(found, pa.list_(pa.int32()))})

    return rows.mapInArrow(run, "y int, slots array<int>")


def _counts(rows: DataFrame) -> DataFrame:
    """Per slot, the training documents of either class that have it; each task sends a slot once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, 1 << SLOT_BITS), np.int64)
        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                n[int(y > 0), slots(text)] += 1
        at = np.flatnonzero(n.any(axis=0))
        yield pa.record_batch({"slot": at.astype(np.int32), "n0": n[0, at], "n1": n[1, at]})

    each = rows.mapInArrow(run, "slot int, n0 long, n1 long")
    return each.groupBy("slot").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))


def train(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = PER_CLASS, kept: int = KEPT) -> Model:
    rows = labelled.sample(docs, labels, "toxic", learn, per_class)
    size = {r["toxic"]: r["n"] for r in rows.groupBy((F.col("y") > 0).cast("int").alias("toxic")).agg(F.count("y").alias("n")).collect()}
    nothing = np.zeros(1 << SLOT_BITS)
    if len(size) < 2:
        share = 1.0 if 1 in size else 0.0
        return Model(nothing, 500.0 if share else -500.0)
    table = _counts(rows).toArrow()
    at, n0, n1 = (table.column(c).to_numpy().astype(float) for c in ("slot", "n0", "n1"))
    # Log ratio of the smoothed shares, and its standard error.
    r = np.log((n1 + 1) / (size[1] + 2)) - np.log((n0 + 1) / (size[0] + 2))
    sure = np.abs(r) / np.sqrt(1 / (n1 + 1) + 1 / (n0 + 1))
    best = np.lexsort((at, -sure))[:kept]
    best = best[sure[best] >= SURE]
    chosen, ratio = at[best].astype(np.int64), r[best]
    place = np.full(1 << SLOT_BITS, -1)
    place[chosen] = np.arange(len(chosen))
    found = _kept_slots(rows, chosen).toArrow()
    y = found.column("y").to_numpy().astype(float)
    x = np.zeros((len(y), len(chosen)), np.float32)
    lists = found.column("slots").combine_chunks()
    x[np.repeat(np.arange(len(y)), lists.value_lengths().to_numpy()), place[lists.flatten().to_numpy()]] = 1
    w, intercept = _logistic(x * ratio.astype(np.float32), y, RIDGE)
    nothing[chosen] = w * ratio
    return Model(nothing, intercept)


def scorer(model: Model) -> Callable[[Column], Column]:
    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array([model.score(t.as_py()) for t in texts], pa.float64())

    return score


def score(docs: DataFrame, model: Model, text: str = "text", to: str = "score") -> DataFrame:
    """``docs`` with the score (0 to 1) in column ``to``."""
    return docs.withColumn(to, scorer(model)(F.col(text)))
