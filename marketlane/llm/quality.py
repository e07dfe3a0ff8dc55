"""Quality: a regularised quadratic discriminant over statistics of a text.

Each text gives ``FEATURES``: logs of lengths and square roots of shares, which
come closer to normal distributions than the plain figures. For either class
the mean and covariance are taken, the covariance drawn towards the pooled one
and towards its own diagonal (``shrink``). The score is the logistic function
of the difference of the two log densities (from Mahalanobis distances by
triangular solves with Cholesky factors that are made once) and log priors.

Training reads at most ``per_class`` labelled documents of either class; its
sums are made by Spark tasks and are a few hundred numbers whatever the input.
Scoring reads whole texts. Empty and null texts have a defined vector (zeros)
and are scored like any other. With a class missing, every score is the share
of good rows (0 without rows). Repeated rows score alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlane.llm import labelled

PER_CLASS = 10_000
LEAST_VARIANCE = 1e-4  # along any axis, of standardised features
SHRINK = (0.1, 0.05)  # towards the pooled covariance, towards the own diagonal
FEATURES = (
    "log_chars", "log_words", "word_length", "word_length_spread", "upper", "digits", "symbols", "marks",
    "stops", "bars", "shouts", "log_line", "distinct_words", "distinct_lines", "bytes_per_char",
)

_KIND = np.zeros(256, np.uint8)
for _k, _chars in enumerate((b" \t\n\x0b\x0c\r", bytes(range(65, 91)), b"0123456789", b"#$%&*@^~_=<>{}[]\\/`", b",;:'\"()-", b".", b"|", b"!?"), 1):
    _KIND[list(_chars)] = _k


def features(text: str | None) -> np.ndarray:
    data = (text or "").encode("utf-8", "replace")
    if not data.strip():
        return np.zeros(len(FEATURES))
    words, lines = data.split(), [x for x in data.split(b"\n") if x.strip()]
    n, chars = len(data), len(text)
    kinds = np.bincount(_KIND[np.frombuffer(data, np.uint8)], minlength=9) / n
    lengths = np.fromiter(map(len, words), float, len(words))
    return np.array([
        np.log(chars), np.log(len(words)), np.log(lengths.mean()), lengths.std() / lengths.mean(),
        *np.sqrt(kinds[2:9]),
        np.log(chars / len(lines)), np.sqrt(len(set(words)) / len(words)), np.sqrt(len(set(lines)) / len(lines)), n / chars,
    ])


@dataclass(frozen=True)
class Model:
    centre: np.ndarray
    scale: np.ndarray
    means: tuple[np.ndarray, ...]
    inverses: tuple[np.ndarray, ...]  # of the Cholesky factors
    constants: tuple[float, ...]

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Chance of a good text for each row of features."""
        if not self.means:
            return np.full(len(rows), self.constants[0])
        z = (rows - self.centre) / self.scale
        logs = [c - 0.5 * (((z - m) @ i.T) ** 2).sum(axis=1) for m, i, c in zip(self.means, self.inverses, self.constants)]
        return 1 / (1 + np.exp(-np.clip(logs[1] - logs[0], -500, 500)))


def _moments(rows: DataFrame) -> dict[int, tuple[float, np.ndarray, np.ndarray]]:
    """Per class: rows, sum of the features, sum of their products."""
    d = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                x = features(text)
                total[int(y > 0)] += np.concatenate([[1.0], x, np.outer(x, x).ravel()])
        yield pa.record_batch({
            "y": pa.array([0] * total.shape[1] + [1] * total.shape[1], pa.int32()),
            "at": np.tile(np.arange(total.shape[1], dtype=np.int32), 2),
            "v": total.ravel(),
        })

    sums = rows.mapInArrow(run, "y int, at int, v double").groupBy("y", "at").agg(F.sum("v").alias("v")).toArrow()
    out = {}
    for y in (0, 1):
        v = np.zeros(1 + d + d * d)
        mine = sums.column("y").to_numpy() == y
        v[sums.column("at").to_numpy()[mine]] = sums.column("v").to_numpy()[mine]
        out[y] = (v[0], v[1 : d + 1], v[d + 1 :].reshape(d, d))
    return out


def train(docs: DataFrame, labels: DataFrame, learn: Column, per_class: int = PER_CLASS, shrink: tuple[float, float] = SHRINK) -> Model:
    sums = _moments(labelled.sample(docs, labels, "quality", learn, per_class))
    n = [sums[y][0] for y in (0, 1)]
    d = len(FEATURES)
    if min(n) < 2:
        return Model(np.zeros(d), np.ones(d), (), (), (n[1] / max(sum(n), 1),))
    centre = (sums[0][1] + sums[1][1]) / sum(n)
    spread = np.diag(sums[0][2] + sums[1][2]) / sum(n) - centre**2
    scale = np.where(spread > 1e-9, np.sqrt(np.maximum(spread, 1e-9)), 1.0)
    means, covs = [], []
    for y in (0, 1):
        m = sums[y][1] / n[y]
        covs.append((sums[y][2] / n[y] - np.outer(m, m)) / np.outer(scale, scale))
        means.append((m - centre) / scale)
    pooled = (n[0] * covs[0] + n[1] * covs[1]) / sum(n)
    inverses, constants = [], []
    for y in (0, 1):
        c = (1 - shrink[0]) * covs[y] + shrink[0] * pooled
        c = (1 - shrink[1]) * c + shrink[1] * np.diag(np.diag(c))
        # A feature that hardly varies in the sample must not decide.
        values, axes = np.linalg.eigh((c + c.T) / 2)
        low = np.linalg.cholesky((axes * np.maximum(values, LEAST_VARIANCE)) @ axes.T)
        inverses.append(np.linalg.inv(low))
        constants.append(float(np.log(n[y] / sum(n)) - np.log(np.diag(low)).sum()))
    return Model(centre, scale, tuple(means), tuple(inverses), tuple(constants))


def score(docs: DataFrame, model: Model, text: str = "text", to: str = "score") -> DataFrame:
    """``docs`` with the score (0 to 1) in column ``to``."""

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(np.array([features(t.as_py()) for t in texts]).reshape(-1, len(FEATURES))), pa.float64())

    return docs.withColumn(to, scored(F.col(text)))
