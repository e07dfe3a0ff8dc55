"""Encoding against the public library, and round trips."""

import random
from dataclasses import replace

import numpy as np
import pytest
import sentencepiece

from marketlane.llm import pieces, queries

ODD = ["", None, " ", "  a   b ", "\n\n\t x\x00y", "你好 wörld 🎉🎉 ñ", " " * 50 + "x", "a" * 5000, "tion" * 400, "if x:\n        return  y", "▁x ▁", "<0x0A> <s> </s> <unk>"]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.read()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def random_texts(v, n):
    rng = random.Random(7)
    names = sorted(v.ids)
    for _ in range(n):
        yield "".join(rng.choice("abcdethinos  \n▁é你1,.'") for _ in range(rng.randint(1, 150)))
        yield "".join(rng.choice(names) for _ in range(rng.randint(1, 15))).replace(pieces.MARK, " ")


def test_ids_equal_the_library(vocabulary, library):
    texts = [t or "" for t in ODD] + list(random_texts(vocabulary, 1500))
    got = pieces.Encoder(vocabulary).encode(texts)
    for t, ids in zip(texts, got):
        assert ids.tolist() == library.encode(t), t
        assert pieces.decoded(vocabulary, ids) == library.decode(ids.tolist()) == t.replace(pieces.MARK, " ")


def test_memory_is_bounded(vocabulary, library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", 2000)
    monkeypatch.setattr(pieces, "PAIRS", 20)
    e = pieces.Encoder(vocabulary)
    for t in random_texts(vocabulary, 60):
        assert e.encode([t])[0].tolist() == library.encode(t)


def test_unigram_path_has_the_best_sum(vocabulary):
    v = replace(vocabulary, merges=False)

    def best(word):
        """Largest sum over all ways to cut a word into pieces."""
        if not word:
            return 0.0
        ends = [e for e in range(1, len(word) + 1) if word[:e] in v.ids]
        return max(v.scores[word[:e]] + best(word[e:]) for e in ends)

    words = ["the", "nations", "andere", "informa", "xqzt", "thethe"]
    ids = pieces.Encoder(v).encode([" ".join(words)])[0]
    names = {i: p for p, i in v.ids.items()}
    assert sum(v.scores[names[i]] for i in ids.tolist()) == sum(best(pieces.MARK + w) for w in words)
    assert pieces.decoded(v, ids) == " ".join(words)


def test_frames(spark, vocabulary, library):
    rows = [(i, t, "kept") for i, t in enumerate([*ODD, "a b", "a b"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lossless string")
    out = pieces.encode(docs, vocabulary)
    assert out.columns == ["doc_id", "text", "ids", "n_tokens", "lossless"]
    for r in pieces.decode(out, vocabulary, to="back").collect():
        assert list(r.ids) == library.encode(r.text or "") and r.n_tokens == len(r.ids)
        assert r.lossless == (pieces.MARK not in (r.text or ""))
        assert r.back == (r.text or "").replace(pieces.MARK, " ")
    assert pieces.encode(docs.limit(0), vocabulary).count() == 0


def test_query(spark, folder, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    out = queries.QUERIES["op4_sentencepiece"](spark, folder).collect()
    assert len(out) == len(texts)
    assert all(np.array_equal(r.ids, library.encode(texts[r.doc_id])) and r.lossless for r in out)
