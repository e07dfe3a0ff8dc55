"""Nearest neighbours against a full comparison."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlane.llm import nearest, queries


def exact(vectors, asked, k):
    ids = sorted(vectors)
    x = np.array([vectors[i] for i in ids])
    out = {}
    for q in asked:
        s = (x * np.array(vectors[q])).sum(axis=1)
        order = np.lexsort((ids, -s))
        out[q] = [(ids[j], s[j]) for j in order if ids[j] != q][:k]
    return out


def recall(got, want):
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q, near in want.items():
        mine = sorted(found.get(q, []))
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1))
        assert [m[1:] for m in mine] == sorted((m[1:] for m in mine), key=lambda m: (-m[1], m[0]))
        hits += len({m[1] for m in mine} & {i for i, _ in near})
    assert set(found) <= set(want)
    return hits / sum(map(len, want.values()))


def test_given_vectors(spark):
    path = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{path}/embeddings.parquet").collect()
    vectors = {r.vec_id: np.array(r.embedding, dtype=float) for r in rows}
    out = queries.QUERIES["op10_nearest"](spark, path)
    assert out.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]
    got = out.collect()
    assert recall(got, exact(vectors, [i for i in vectors if i % 20 == 0], 20)) >= 0.9
    for r in got:
        assert r.score == pytest.approx(float(vectors[r.query_id] @ vectors[r.vec_id]), abs=1e-12)


def test_repeated_vectors_and_uneven_lengths(spark, monkeypatch):
    monkeypatch.setattr(nearest, "GROUP_ROWS", 50)
    monkeypatch.setattr(nearest, "QUERY_ROWS", 20)
    rng = np.random.default_rng(2)
    vectors = {}
    for i in range(600):
        vectors[i] = [1.0, 2.0, 0.5, -1.0] if i % 3 == 0 else (rng.normal(size=4) * rng.choice([0.1, 1, 3])).tolist()
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    got = nearest.search(df, F.col("vec_id") % 4 == 0, 7).collect()
    assert recall(got, exact(vectors, [i for i in vectors if i % 4 == 0], 7)) >= 0.9
    # Ties among equal vectors go to the smaller ids.
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"]) if r.query_id == 0 and abs(r.score - 6.25) < 1e-12] == [
        i for i in (3, 6, 9, 12, 15, 18, 21) if any(r.query_id == 0 and r.vec_id == i for r in got)
    ]


def test_small_tables_give_all_candidates(spark):
    rng = np.random.default_rng(4)
    for n in (2, 15, 21):
        vectors = {i: rng.normal(size=16).tolist() for i in range(n)}
        df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
        got = nearest.search(df, F.col("vec_id") >= 0, 20).collect()
        assert recall(got, exact(vectors, list(vectors), 20)) == 1.0
        assert len(got) == n * (n - 1)


def test_clusters_and_lone_vectors(spark):
    rng = np.random.default_rng(6)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    centres = unit(rng.normal(size=(40, 32)))
    tight = unit(np.repeat(centres, 50, axis=0) + 0.01 * rng.normal(size=(2000, 32)))
    vectors = dict(enumerate(np.vstack([tight, unit(rng.normal(size=(20, 32)))]).tolist()))
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>")
    got = nearest.search(df, (F.col("vec_id") % 50 == 0) | (F.col("vec_id") >= 2000), 20).collect()
    for q in [*range(0, 2000, 50), *range(2000, 2020)]:
        mine = [r for r in got if r.query_id == q]
        assert len(mine) == 20 and recall(mine, exact(vectors, [q], 20)) >= 0.9


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 0.0], "a"), (1, [0.5, 0.5], "b"), (2, None, "c"), (3, [], "d"), (4, [0.0, 0.0], "e"), (5, [float("nan"), 1.0], "f"),
        (6, [float("inf"), 1.0], "g"), (7, [None, 1.0], "h"), (8, [1.0, 2.0, 3.0], "i"), (None, [1.0, 1.0], "j"), (1, [0.5, 0.5], "b"),
        (9, [-1.0, 0.0], "k"),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    out = nearest.search(df, F.col("vec_id") >= 0, 20)
    got = {}
    for r in out.collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == {0, 1, 9} and got[0][0] == 1 and all(q not in v for q, v in got.items())
    assert nearest.search(df.limit(0), F.col("vec_id") >= 0, 20).count() == 0
    assert nearest.search(df.where("vec_id = 0"), F.col("vec_id") >= 0, 20).count() == 0
    assert nearest.search(df, F.lit(False), 20).count() == 0


def test_visits_come_in_falling_order_of_chance():
    tables = nearest.Tables(8, 1.0)
    tables.spread = 0.8
    rng = random.Random(1)
    place = np.array([rng.uniform(-3, 3) for _ in range(nearest.FUNCTIONS)])
    at, sums = tables.visits(place, 0.9)
    gains = np.diff(sums, prepend=0)
    assert (np.diff(gains) <= 1e-12).all() and sums[-1] >= 0.9 > sums[-2]
    assert not at[0].any() or gains[0] >= gains[1]
    assert len({tuple(o) for o in at.tolist()}) == len(at)
