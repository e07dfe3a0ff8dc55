"""Near-duplicate classes against a comparison of all sets."""

import random

import numpy as np
import pytest

from marketlane.llm import components, near_dups, queries, wordhash


def plain_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def plain_components(texts, percent):
    sets = {i: plain_set(t) for i, t in texts.items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for i, s in sets.items():
        for g in s:
            where.setdefault(g, []).append(i)
    near = {(i, j) for ids in where.values() if len(ids) < 500 for i in ids for j in ids if i < j}
    for i, j in near:
        common = len(sets[i] & sets[j])
        if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            a, b = sorted((find(i), find(j)))
            parent[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def check(out, texts, percent):
    want = plain_components(texts, percent)
    got = {r.doc_id: r for r in out.collect()}
    assert set(got) == set(texts)
    for i, (n, c) in want.items():
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (n, c, i == c), i


def test_query(spark):
    path = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    check(queries.QUERIES["op8_near_dups"](spark, path), texts, 85)


def edited(words, rng, share):
    return [rng.choice(["alpha", "beta", "gamma"]) + str(rng.random()) if rng.random() < share else w for w in words]


@pytest.mark.parametrize("percent, tile", [(85, 2048), (80, 7)])
def test_groups_with_edits(spark, percent, tile, monkeypatch):
    monkeypatch.setattr(near_dups, "TILE", tile)
    rng = random.Random(percent)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = {}
    passage = rng.choices(vocabulary, k=60)
    for _ in range(25):
        base = rng.choices(vocabulary, k=rng.choice([4, 12, 80, 300])) + passage * (rng.random() < 0.5)
        for _ in range(rng.randint(1, 14)):
            share = rng.choice([0, 0.004, 0.01, 0.02, 0.04])
            texts[len(texts)] = " ".join(edited(base, rng, share))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    check(near_dups.link(docs.repartition(8), percent), texts, percent)


def test_odd_rows(spark, rows):
    data = [
        (5, "One two three four five six", "a"), (3, "one TWO\tthree\nfour five  six", "b"), (5, "One two three four five six", "a"), (7, None, "c"),
        (8, "", "d"), (9, " \n", "e"), (10, "two words", "f"), (11, "Two Words", "g"), (None, "two words", "h"), (12, "one two three four", "i"),
    ]
    out = near_dups.link(spark.createDataFrame(data, "doc_id long, text string, component_id string"), 85)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert rows(out) == sorted(
        [
            (5, 2, 3, False), (5, 2, 3, False), (3, 2, 3, True), (7, 0, 7, True), (8, 0, 8, True), (9, 0, 9, True), (10, 1, 10, True),
            (11, 1, 10, False), (None, 1, None, True), (12, 1, 12, True),
        ],
        key=lambda t: [(v is not None, v) for v in t],
    )
    assert near_dups.link(spark.createDataFrame([], "doc_id long, text string"), 85).count() == 0


def test_signatures_within_the_distance_always_share_a_key():
    rng = np.random.default_rng(1)
    for percent in (80, 85, 95):
        plan = near_dups.layout(percent)
        a = rng.integers(0, 1 << 16, (400, near_dups.SYMBOLS), np.uint16)
        b = a.copy()
        for row in b:
            at = rng.choice(near_dups.SYMBOLS, plan.most_errors, replace=False)
            row[at] ^= np.uint16(1)
        ka, kb = near_dups.chunk_keys(a, plan), near_dups.chunk_keys(b, plan)
        assert (ka == kb).any(axis=1).all()


def test_set_hashes_match_plain_sets():
    texts = [b"a b c d e f", b"A  b\tc\nd e f", b"", b"x", b"a b c d", b"\x00 \xc3\xa9 b c d e", b"a" * 5000]
    got = list(wordhash.shingle_sets(texts, 5))
    assert [len(s) for s in got] == [len(plain_set(t.decode())) for t in texts]
    assert np.array_equal(got[0], got[1])


def test_components(spark, rows):
    edges = [(i, i + 1) for i in range(60)] + [(100, 105), (105, 103), (7, 7), (200, 1), (103, 100)]
    got = dict(rows(components.components(spark.createDataFrame(edges, "u long, v long"))))
    assert got == {**dict.fromkeys([*range(61), 200], 0), 100: 100, 103: 100, 105: 100}
    assert components.components(spark.createDataFrame([], "u long, v long")).count() == 0
