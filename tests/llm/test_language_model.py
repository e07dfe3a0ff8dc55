"""The recurrent model: gradients, whole-document state, a proper distribution, counts and held-out likelihood."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlane.llm import language_model, queries, recurrent

SHAPE = recurrent.Shape(heads=10, width=4, spellings=3)


@pytest.fixture()
def model():
    rng = np.random.default_rng(5)
    return {k: rng.normal(0, 0.4, s).astype(np.float32) for k, s in SHAPE.sizes().items()}


def documents(n, longest, seed=1):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, longest, n)
    return rng.integers(0, SHAPE.heads + 2 * SHAPE.spellings, int(sizes.sum())).astype(np.int16), sizes


def step_by_step(m, codes):
    """Log-likelihood of one document, and the whole distribution over codes at its end."""
    n = recurrent.UNITS
    h, before, total = np.zeros(n), 0, 0.0
    sig = lambda v: 1 / (1 + np.exp(-v))
    soft = lambda v: np.exp(v - v.max()) / np.exp(v - v.max()).sum()
    for code in codes.tolist():
        x, a = m["x"][before].astype(float), h @ m["u"].astype(float) + m["u0"]
        r, z = sig(x[:n] + a[:n]), sig(x[n : 2 * n] + a[n : 2 * n])
        fresh = np.tanh(x[2 * n :] + r * a[2 * n :])
        h = fresh + z * (h - fresh)
        classes = soft(h @ m["c"] + m["c0"])
        if code < SHAPE.heads:
            k = code // SHAPE.width
            total += math.log(classes[k]) + math.log(soft(h @ m["w"][k] + m["w0"][k])[code % SHAPE.width])
            before = code
        else:
            kind = code - SHAPE.heads
            total += math.log(classes[SHAPE.head_classes + min(kind, SHAPE.spellings)])
            before = SHAPE.heads + kind % SHAPE.spellings
    return total


def test_documents_are_scored_whole(model):
    codes, sizes = documents(400, 60)
    sizes = np.append(sizes, 700)
    codes = np.append(codes, documents(1, 2, 3)[0].repeat(700)[:700])
    codes = codes[: sizes.sum()]
    got = recurrent.Network(SHAPE, model).score(codes, sizes)
    ends = np.cumsum(sizes)
    want = [step_by_step(model, codes[e - n : e]) for e, n in zip(ends, sizes)]
    np.testing.assert_allclose(got, want, rtol=2e-4, atol=2e-3)


def test_gradients(model, monkeypatch):
    """Of a window's mean loss, against differences; the state before it counts as given."""
    codes, sizes = documents(30, 12)
    sizes = np.minimum(sizes, recurrent.WINDOW)
    codes = codes[: sizes.sum()]
    net = recurrent.Network(SHAPE, {k: v.copy() for k, v in model.items()})
    lanes = recurrent.Lanes(codes.astype(np.int64), sizes, len(sizes))
    taken = {}
    monkeypatch.setattr(net, "_step", lambda grad, rows, share: taken.update(grad=grad, rows=rows, share=share))
    place, there = next(lanes.windows())
    net._learn(lanes, place, there, np.zeros((recurrent.UNITS, place.shape[1]), np.float32))
    full = np.zeros_like(model["x"])
    full[taken["rows"]] = taken["grad"]["x"]
    grads = taken["grad"] | {"x": full}
    rng = np.random.default_rng(0)
    for name, value in model.items():
        for at in rng.choice(value.size, 6, replace=False):
            losses = []
            for move in (1e-2, -1e-2):
                moved = {k: v.copy() for k, v in model.items()}
                moved[name].flat[at] += move
                ends = np.cumsum(sizes)
                losses.append(-sum(step_by_step(moved, codes[e - n : e]) for e, n in zip(ends, sizes)))
            assert abs((losses[0] - losses[1]) / 2e-2 - grads[name].flat[at]) < 2e-2 + 2e-2 * abs(grads[name].flat[at]), name


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [""]


def test_shares_sum_to_one():
    counts = Counter({"": 5, **{f"w{k}": 1 + (k * 7919 % 40) ** 2 // 100 for k in range(3000)}})
    top = sorted(counts, key=lambda w: (w != "", -counts[w], w))[: language_model.HEADS]
    often = [0] * language_model.SHAPE.spellings
    for w, n in counts.items():
        if w not in top and n > 1:
            often[language_model._spelling(w)] += n
    once, twice = (sum(n == k for n in counts.values()) for k in (1, 2))
    c = language_model.Counts(sum(counts.values()), len(counts), once, twice, {w: counts[w] for w in top}, tuple(often))
    rare = [(w, n) for w, n in counts.items() if w not in top] + [("never", 0)]
    codes = np.array([language_model.HEADS + language_model._spelling(w) + (n < 2) * language_model.SHAPE.spellings for w, n in rare])
    shares = 10 ** c.share(np.array([n for _, n in rare]), codes)
    sums = np.bincount(np.minimum(codes - language_model.HEADS, language_model.SHAPE.spellings), shares)
    np.testing.assert_allclose(sums[sums > 0], 1)
    m = c.start()
    heads = np.exp(m["w0"]).sum(axis=1)
    np.testing.assert_allclose(heads, 1, atol=1e-3)
    np.testing.assert_allclose(np.exp(m["c0"]).sum(), 1, atol=1e-3)


def expected(texts, learn):
    counts = Counter(w for t, yes in zip(texts, learn) if yes for w in words(t))
    n, v = sum(counts.values()), len(counts)
    base = [sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(t)) for t in texts]
    return n, [len(words(t)) for t in texts], [sum(counts[w] > 0 for w in words(t)) for t in texts], base


def test_odd_rows(spark):
    texts = ["", None, " \n\t ", "One two ONE", "Éa éA x y", "long " * 20_000, "same", "same", "never seen before", "\x1c a \x00"]
    rows = [(i if i else None, t, i != 8, 1.0, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, learnt boolean, SCORE double, learn string").repartition(3)
    n, sizes, known, base = expected(texts, [r[2] for r in rows])
    out = language_model.score(docs, F.col("learnt"), block_bytes=2000)
    assert out.columns == ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    for r in out.collect():
        i = r.doc_id or 0
        assert (r.n_tokens, r.n_known, r.train_tokens) == (sizes[i], known[i], n)
        assert abs(r.base_score - base[i]) < 1e-6 * abs(base[i]) + 1e-9 and -1e7 < r.score < 0
    assert language_model.score(docs.limit(0), F.col("learnt")).count() == 0
    unlearnt = language_model.score(docs, F.lit(None).cast("boolean")).collect()
    assert len(unlearnt) == len(texts) and all(r.train_tokens == r.n_known == r.base_score == 0 and math.isfinite(r.score) for r in unlearnt)


def test_query(spark, folder):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in docs}
    n, sizes, known, base = expected(docs.values(), [not held[i] for i in docs])
    out = {r.doc_id: r for r in queries.QUERIES["op13_language_model"](spark, folder).collect()}
    for k, i in enumerate(docs):
        r = out[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], sizes[k], known[k], n)
        assert abs(r.base_score - base[k]) < 1e-9 * abs(base[k])
    mine = [r for r in out.values() if r.held_out]
    gain = sum(r.score - r.base_score for r in mine) / sum(r.n_tokens for r in mine)
    assert gain > 0.2  # log10 for each token of documents not learnt from


LEAVED = recurrent.Shape(heads=10, width=4, spellings=3, depth=3)


def leaved_model():
    rng = np.random.default_rng(6)
    return {k: rng.normal(0, 0.4, s).astype(np.float32) for k, s in LEAVED.sizes().items()}


def leaved_documents(n, longest):
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, longest, n)
    codes = rng.integers(0, LEAVED.first_leaf + LEAVED.spellings * LEAVED.leaves, int(sizes.sum()))
    return codes.astype(np.int16), sizes


def leaf_by_leaf(m, codes):
    """Log-likelihood of one document with leaves: own inputs, and the turns to each leaf."""
    n, s = recurrent.UNITS, LEAVED
    h, x, total = np.zeros(n), m["x"][0].astype(float), 0.0
    sig = lambda v: 1 / (1 + np.exp(-v))
    soft = lambda v: np.exp(v - v.max()) / np.exp(v - v.max()).sum()
    for code in codes.tolist():
        a = h @ m["u"].astype(float) + m["u0"]
        r, z = sig(x[:n] + a[:n]), sig(x[n : 2 * n] + a[n : 2 * n])
        fresh = np.tanh(x[2 * n :] + r * a[2 * n :])
        h = fresh + z * (h - fresh)
        classes = soft(h @ m["c"] + m["c0"])
        spelling, leaf = divmod(code - s.first_leaf, s.leaves)
        if code < s.heads:
            k = code // s.width
            total += math.log(classes[k]) + math.log(soft(h @ m["w"][k] + m["w0"][k])[code % s.width])
            x = m["x"][code].astype(float)
        elif code < s.first_leaf:
            kind = code - s.heads
            total += math.log(classes[s.head_classes + min(kind, s.spellings)])
            x = m["x"][s.heads + kind % s.spellings].astype(float)
        else:
            total += math.log(classes[s.head_classes + spelling])
            node = 1
            for bit in f"{leaf:0{s.depth}b}":
                p = sig(h @ m["t"][spelling * s.leaves + node] + m["t0"][spelling * s.leaves + node])
                total += math.log(p if bit == "1" else 1 - p)
                node = 2 * node + int(bit)
            x = m["x"][s.heads + spelling] + m["l"][code - s.first_leaf].astype(float)
    return total


def test_rare_words_are_told_apart():
    m = leaved_model()
    codes, sizes = leaved_documents(200, 60)
    got = recurrent.Network(LEAVED, m).score(codes, sizes)
    ends = np.cumsum(sizes)
    np.testing.assert_allclose(got, [leaf_by_leaf(m, codes[e - n : e]) for e, n in zip(ends, sizes)], rtol=2e-4, atol=2e-3)
    # The leaves of a spelling share the probability that a code without leaf has.
    leaf = np.arange(LEAVED.spellings * LEAVED.leaves)
    each = np.exp(recurrent.Network(LEAVED, m).score(leaf + LEAVED.first_leaf, np.ones(len(leaf), int)))
    spelt = np.arange(LEAVED.spellings) + LEAVED.heads
    whole = np.exp(recurrent.Network(LEAVED, m).score(spelt, np.ones(len(spelt), int)))
    np.testing.assert_allclose(each.reshape(LEAVED.spellings, -1).sum(axis=1), whole, rtol=1e-4)


def test_gradients_of_leaves(monkeypatch):
    m = leaved_model()
    codes, sizes = leaved_documents(30, 12)
    net = recurrent.Network(LEAVED, {k: v.copy() for k, v in m.items()})
    lanes = recurrent.Lanes(codes.astype(np.int64), sizes, len(sizes))
    taken = {}
    monkeypatch.setattr(net, "_step", lambda grad, rows, share: taken.update(grad=grad))
    place, there = next(lanes.windows())
    net._learn(lanes, place, there, np.zeros((recurrent.UNITS, place.shape[1]), np.float32))
    ends = np.cumsum(sizes)
    rng = np.random.default_rng(0)
    for name in ("l", "t", "t0"):
        full = np.zeros_like(m[name])
        full[taken["grad"][name][0]] = taken["grad"][name][1]
        for at in rng.choice(full.size, 8, replace=False):
            losses = []
            for move in (1e-2, -1e-2):
                moved = {k: v.copy() for k, v in m.items()}
                moved[name].flat[at] += move
                losses.append(-sum(leaf_by_leaf(moved, codes[e - n : e]) for e, n in zip(ends, sizes)))
            assert abs((losses[0] - losses[1]) / 2e-2 - full.flat[at]) < 2e-2 + 2e-2 * abs(full.flat[at]), name


def test_trees_start_from_the_shares():
    counts = np.arange(LEAVED.spellings * LEAVED.leaves, dtype=float)
    m = recurrent.start(LEAVED, np.ones(LEAVED.heads), counts.reshape(LEAVED.spellings, -1).sum(axis=1), 1, counts)
    m["x"][:] = 0
    leaf = np.flatnonzero(counts)
    logs = recurrent.Network(LEAVED, m).score(leaf + LEAVED.first_leaf, np.ones(len(leaf), int))
    np.testing.assert_allclose(np.exp(logs), counts[leaf] / (counts.sum() + LEAVED.heads + 1), rtol=1e-3)


def test_words_of_a_spelling_have_predictions_of_their_own(spark):
    """Two frequent words below the heads, spelt alike: the model learns which follows which."""
    heads = " ".join(f"h{k:03d} " * 40 for k in range(language_model.HEADS))
    pairs = [("alpha", "zzone"), ("beta", "zztwo")]
    texts = [heads] + [" ".join(f"{a} {b}" for a, b in (pairs if k % 2 else pairs[::-1])) for k in range(30)] * 30
    texts += ["alpha zzone " * 50, "alpha zztwo " * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(1)
    got = {r.doc_id: r.score for r in language_model.score(docs, F.col("doc_id") < len(texts) - 2).collect()}
    assert got[len(texts) - 2] > got[len(texts) - 1] + 5


def test_sums_by_id():
    """Runs of one id over many small products, levels of several ids, single rows."""
    rng = np.random.default_rng(3)
    for n in (1, 15, 16, 17, 400):
        ids = np.sort(np.concatenate([rng.integers(0, 9, (1, n)), 100 + rng.integers(0, 400, (1, n)), np.full((1, n), 900)]), axis=1)
        values, weights = rng.normal(size=(n, 5)).astype(np.float32), rng.normal(size=(3, n)).astype(np.float32)
        for w in (None, weights):
            found, sums = recurrent.sums_by_id(ids, values, w)
            want = np.zeros((901, 5))
            for level in range(3):
                np.add.at(want, ids[level], values * (1 if w is None else w[level][:, None]))
            assert found.tolist() == sorted(set(ids.ravel().tolist()))
            np.testing.assert_allclose(sums, want[found], rtol=1e-4, atol=1e-4)


def test_deep_trees(monkeypatch):
    """Levels below those that are worked out whole: scores, and gradients against differences."""
    deep = recurrent.Shape(heads=10, width=4, spellings=3, depth=recurrent.TOP + 2)
    rng = np.random.default_rng(8)
    m = {k: rng.normal(0, 0.4, s).astype(np.float32) for k, s in deep.sizes().items()}
    sizes = rng.integers(1, 12, 40)
    codes = rng.integers(0, deep.first_leaf + deep.spellings * deep.leaves, int(sizes.sum())).astype(np.int16)
    monkeypatch.setitem(globals(), "LEAVED", deep)
    ends = np.cumsum(sizes)
    want = [leaf_by_leaf(m, codes[e - n : e]) for e, n in zip(ends, sizes)]
    for steps in (1, 5, recurrent.SCORED):
        monkeypatch.setattr(recurrent, "SCORED", steps)
        np.testing.assert_allclose(recurrent.Network(deep, m).score(codes, sizes), want, rtol=2e-4, atol=2e-3)
    net, taken = recurrent.Network(deep, {k: v.copy() for k, v in m.items()}), {}
    lanes = recurrent.Lanes(codes, sizes, len(sizes))
    monkeypatch.setattr(net, "_step", lambda grad, rows, share: taken.update(grad))
    place, there = next(lanes.windows())
    net._learn(lanes, place, there, np.zeros((recurrent.UNITS, place.shape[1]), np.float32))
    for name in ("l", "t", "t0"):
        assert len(np.unique(taken[name][0])) == len(taken[name][0])
        full = np.zeros_like(m[name])
        full[taken[name][0]] = taken[name][1]
        for at in rng.choice(np.flatnonzero(full), 12, replace=False):
            losses = []
            for move in (1e-2, -1e-2):
                moved = {k: v.copy() for k, v in m.items()}
                moved[name].flat[at] += move
                losses.append(-sum(leaf_by_leaf(moved, codes[e - n : e]) for e, n in zip(ends, sizes)))
            assert abs((losses[0] - losses[1]) / 2e-2 - full.flat[at]) < 2e-2 + 2e-2 * abs(full.flat[at]), name
