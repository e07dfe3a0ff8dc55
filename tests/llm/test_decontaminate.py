"""Benchmark passages planted in documents, and alignment against a plain table."""

import random
import re

import numpy as np

from marketlane.llm import decontaminate, queries, wordhash

VOCABULARY = [f"w{i}" for i in range(400)] + ["the", "of", "and"] * 60


def plain_align(item, part):
    h = [[0] * (len(part) + 1) for _ in range(len(item) + 1)]
    for i, a in enumerate(item, 1):
        for j, b in enumerate(part, 1):
            d = h[i - 1][j - 1] + (decontaminate.MATCH if a == b else decontaminate.MISMATCH)
            h[i][j] = max(0, d, h[i - 1][j] + decontaminate.GAP, h[i][j - 1] + decontaminate.GAP)
    return max(map(max, h)) / (decontaminate.MATCH * len(item))


def test_alignment_equals_the_plain_table():
    rng = np.random.default_rng(5)
    for _ in range(60):
        item, part = (rng.integers(0, 6, rng.integers(1, 25)).astype(np.uint64) for _ in (0, 1))
        score, start, end = decontaminate.align(item, part)
        assert score == plain_align(item.tolist(), part.tolist())
        if score:
            assert plain_align(item.tolist(), part[start:end].tolist()) == score


def edit(words, rng, share):
    out = []
    for w in words:
        r = rng.random()
        out += [] if r < share / 3 else [w, "added"] if r < share * 2 / 3 else ["other"] if r < share else [w]
    return out


def test_planted_passages(spark):
    rng = random.Random(11)
    item = [[f"q{i}x{k}" if rng.random() < 0.5 else rng.choice(VOCABULARY) for k in range(rng.randint(15, 60))] for i in range(30)]
    docs, planted = [], set()
    for d in range(240):
        words = rng.choices(VOCABULARY, k=rng.randint(0, 400))
        if d % 3 == 0:
            i = 0 if d % 2 else rng.randrange(30)  # one item stands in very many documents
            at = rng.randint(0, len(words))
            words[at:at] = edit(item[i], rng, rng.choice([0, 0, 0.1, 0.15]))
            planted.add((d, i))
        docs.append((d, ", ".join(words).title() if d % 2 else "\n".join(words)))
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(item)], "item_id long, text string")
    out = decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string").repartition(6), items)
    got = {(r.doc_id, r.item_id): r for r in out.collect()}
    assert set(got) == planted
    for (d, i), r in got.items():
        found = [w.lower() for w in re.findall(r"\w+", docs[d][1])][r.first_word : r.end_word]
        assert plain_align(item[i], found) == r.score


def test_given_documents(spark):
    path = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet").collect()
    items = spark.read.parquet(f"{path}/benchmark.parquet").collect()
    exact = {(d.doc_id, i.item_id) for d in docs for i in items if i.text in d.text}
    got = queries.QUERIES["op3_decontaminate"](spark, path).collect()
    assert exact and exact <= {(r.doc_id, r.item_id) for r in got}
    for r in got:  # nothing but copies in other letters or edited ones
        assert r.score >= decontaminate.SCORE


def test_blocks_do_not_change_the_result(spark, folder, rows, monkeypatch):
    docs, items = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = rows(decontaminate.matches(docs, items))
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 700)
    assert rows(decontaminate.matches(docs, items)) == whole


def test_odd_rows(spark, rows):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    items = spark.createDataFrame([(1, passage), (1, passage), (2, None), (3, ""), (None, passage), (4, "?!")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, f"x {passage.upper()} y", "k"), (1, f"x {passage.upper()} y", "k"), (2, None, "k"), (3, "", "k"), (None, passage, "k"), (4, "x y z", None)],
        "doc_id long, text string, item_id string",
    )
    got = rows(decontaminate.matches(docs, items), "doc_id", "item_id", "score", "first_word", "end_word")
    assert got == [(None, 1, 1.0, 0, 10), (1, 1, 1.0, 1, 11), (1, 1, 1.0, 1, 11)]
    assert rows(decontaminate.clean(docs, items).select("doc_id")) == [(None,), (2,), (3,), (4,)]
    assert decontaminate.matches(docs, items.limit(0)).count() == 0
    assert decontaminate.matches(docs.limit(0), items).count() == 0


def test_words():
    h, bounds = wordhash.words(["Ab-c ab".encode(), b"", "é1 É".encode()], wordhash.ALNUM)
    assert bounds.tolist() == [0, 3, 3, 5] and h[0] == h[2] and len(set(h.tolist())) == 4


def test_one_exact_copy_and_many_edited_ones(spark):
    rng = random.Random(3)
    item = [f"q{k}" for k in range(40)]
    edited = [w if k not in (3, 13, 23, 33) else "other" for k, w in enumerate(item)]
    docs = []
    for d, c in enumerate([item] + [edited] * 200):
        words = rng.choices(VOCABULARY, k=100)
        at = rng.randint(0, 100)
        docs.append((d, " ".join(words[:at] + c + words[at:])))
    items = spark.createDataFrame([(0, " ".join(item))], "item_id long, text string")
    got = decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(d, 0) for d in range(201)}


def test_every_pair_that_aligns_is_found(spark):
    rng = random.Random(8)
    item = [rng.choices(VOCABULARY[:12], k=rng.choice([3, 4, 7, 15, 30])) for _ in range(12)]
    docs = []
    for d in range(80):
        words = rng.choices(VOCABULARY[:40], k=rng.randint(0, 60))
        words[10:10] = edit(item[d % 12], rng, rng.choice([0.2, 0.4, 0.6]))
        docs.append((d, " ".join(words)))
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(item)], "item_id long, text string")
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    full = {(d, i): plain_align(w, x.split()) for d, x in docs for i, w in enumerate(item)}
    for score in (0.5, 0.8):
        got = {(r.doc_id, r.item_id): r.score for r in decontaminate.matches(frame, items, score).collect()}
        assert got == {k: v for k, v in full.items() if v >= (1 if len(item[k[1]]) <= decontaminate.WHOLE_WORDS else score)}


def test_copies_without_two_intact_runs(spark):
    item = [f"s{k}" for k in range(15)]
    third = [w if k % 3 else f"x{k}" for k, w in enumerate(item)]
    spread = [x for w in item for x in (w, "added")][:-1]
    docs = [(d, " ".join(["a", "b", *c, "c"])) for d, c in enumerate([third, spread, item[:8], item[:7]])]
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    got = decontaminate.matches(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()
    assert {r.doc_id for r in got} == {0, 1, 2}
