"""Held-out accuracy of the classifiers, and their defined results for odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlane.llm import quality, queries, toxicity

BIG = "/root/testdata/sf0.1"


def held_out(spark, name, label):
    labels = spark.read.parquet(f"{BIG}/labels.parquet").select("doc_id", F.col(label).alias("y"))
    scored = queries.QUERIES[name](spark, BIG)
    assert scored.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    out = scored.toPandas()
    assert len(out) == 10_000 and out.score.between(0, 1).all()
    return out.merge(labels.toPandas(), on="doc_id").query("held_out")


def auc(rows):
    ranks = rows.score.rank()
    yes, no = (rows.y == 1).sum(), (rows.y == 0).sum()
    return (ranks[rows.y == 1].sum() - yes * (yes + 1) / 2) / (yes * no)


def test_toxicity_held_out(spark):
    rows = held_out(spark, "op5_toxicity", "toxic")
    assert auc(rows) > 0.95
    assert (rows.predicted[rows.y == 0] == 0).mean() > 0.99


def test_quality_held_out(spark):
    rows = held_out(spark, "op6_quality", "quality")
    assert auc(rows) > 0.99
    assert (rows.predicted == rows.y).mean() > 0.98


DOCS = [(1, "good words here. " * 20, "a"), (2, "bad idiot words. " * 20, "b"), (3, None, "c"), (4, "", "d"), (None, "good", "e"), (1, "good words here. " * 20, "a")]
LABELS = [(1, 0, 1), (2, 1, 0), (2, 1, 0), (3, None, None), (None, 1, 1), (99, 1, 1)]


@pytest.fixture()
def small(spark):
    docs = spark.createDataFrame([(i, t, x) for k in range(80) for i, t, x in [(None if i is None else i + 1000 * k, t, x) for i, t, x in DOCS]], "doc_id long, text string, y string")
    labels = spark.createDataFrame([(None if i is None else i + 1000 * k, a, b) for k in range(80) for i, a, b in LABELS], "doc_id long, toxic int, quality int")
    return docs, labels


@pytest.mark.parametrize("module", [toxicity, quality])
def test_odd_rows(module, small):
    docs, labels = small
    out = module.score(docs, module.train(docs, labels, F.lit(True)))
    assert out.columns == ["doc_id", "text", "y", "score"]
    rows = out.collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not r.text}) == 1
    by = {r.text: r.score for r in rows}
    first, second = by[DOCS[0][1]], by[DOCS[1][1]]
    assert (first < 0.5 < second) if module is toxicity else (first > 0.5 > second)


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_without_labels_or_with_one_class(module, label, small):
    docs, labels = small
    none = module.score(docs, module.train(docs, labels.limit(0), F.lit(True)))
    assert {round(r.score, 6) for r in none.collect()} == {0.0}
    one = module.score(docs, module.train(docs, labels.where(F.col(label) == 1), F.lit(True)))
    assert {round(r.score, 6) for r in one.collect()} == {1.0}
    assert module.score(docs.limit(0), module.train(docs.limit(0), labels, F.lit(True))).count() == 0


def test_cholesky_scores_equal_log_densities():
    rng = np.random.default_rng(3)
    d = len(quality.FEATURES)
    covs = [np.cov(rng.normal(size=(d, 4 * d))) for _ in (0, 1)]
    means = [rng.normal(size=d), rng.normal(size=d)]
    inverses = tuple(np.linalg.inv(np.linalg.cholesky(c)) for c in covs)
    constants = tuple(float(-0.5 * np.linalg.slogdet(c)[1]) for c in covs)
    model = quality.Model(np.zeros(d), np.ones(d), tuple(means), inverses, constants)
    x = rng.normal(size=(5, d))
    logs = [c - 0.5 * np.einsum("ni,ij,nj->n", x - m, np.linalg.inv(s), x - m) for m, s, c in zip(means, covs, constants)]
    assert np.allclose(model.score(x), 1 / (1 + np.exp(-(logs[1] - logs[0]))))


def test_long_text():
    text = "word " * 300_000
    assert len(toxicity.slots(text)) < 200
    assert np.isfinite(quality.features(text)).all() and np.isfinite(quality.features("x")).all()
