"""Alignment against a plain walk over all byte offsets, with the public libraries' ids."""

import hashlib
import pickle
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketlane import settings
from marketlane.llm import align, queries

ODD = [
    "", None, " ", "  a   b ", "\n\n\t x\x00y", "a. \n b\u00a0c \u3000d", "你好 wörld 🎉🎉 ñ e\u0301", " " * 50 + "x", "a" * 3000, "tion" * 400,
    "if x:\n        return  y", "▁x ▁", "plain ▁ words", "<0x0A> <s> </s> <unk>", "<|endoftext|> of <|endoftext|>", "don't we'll  I've", "\x1c a \x1f b",
    "1234567 89,000.5 ---- ....", "語" * 700 + " " + "é" * 500, "a b", "a b",
]


@pytest.fixture(scope="module")
def files():
    return align.read()


@pytest.fixture(scope="module")
def plain():
    a = Tokenizer.from_file(align.A_FILE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=align.B_FILE)
    letters = align._byte_letters()
    a_bytes = {i: bytes(letters.get(x, 32) for x in entry) for entry, i in a.get_vocab().items()}

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def run(text):
        """Groups (ids of a, ids of b) and links of a text; none where its bytes are not those of the tokens."""
        if not text:
            return [], []
        body = " " + text
        x, y = a.encode(body, add_special_tokens=False).ids, b.encode(text)
        if b"".join(a_bytes[i] for i in x) != body.encode() or b"".join(map(b_bytes, y)) != body.encode():
            return [], []
        ends = [np.cumsum([len(a_bytes[i]) for i in x]).tolist(), np.cumsum([len(b_bytes(i)) for i in y]).tolist()]
        shared = sorted(set(ends[0]) & set(ends[1]))
        groups = []
        for start, end in zip([0, *shared], shared):
            groups.append(tuple([i for i, e in zip(ids, es) if start < e <= end] for ids, es in zip((x, y), ends)))
        links = []
        for p, q in groups:
            left = [(i, 0) for i in p]
            at = 0
            spans = [[], []]
            for side, (ids, size) in enumerate(((p, lambda i: len(a_bytes[i])), (q, lambda i: len(b_bytes(i))))):
                at = 0
                for i in ids:
                    spans[side].append((at, at + size(i), i))
                    at += size(i)
            assert left
            links += [(i, j) for s, e, i in spans[0] for s2, e2, j in spans[1] if s < e2 and s2 < e]
        return groups, links

    return run


def expected(plain, texts):
    held = [plain(t) for t in texts]
    count = Counter(x for _, links in held for x in links)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for groups, links in held:
        listing = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        out.append((
            sum(len(p) for p, _ in groups), sum(len(q) for _, q in groups), len(groups), len(links),
            sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), listing,
        ))
    return out


def random_texts(n):
    rng = random.Random(5)
    for _ in range(n):
        yield "".join(rng.choice(["the", "tion", "ing ", " ", " ", "\n", "é", "你", "1", ".", "'s", "X", "zq", "\u00a0", "🎉"]) for _ in range(rng.randint(1, 60)))


def test_leaves_of_random_ends():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a, b = (np.unique(np.append(rng.choice(n, rng.integers(0, n), replace=False) + 1, n)) for _ in range(2))
        out = align.leaves(a, b, np.array([[0, len(a), 0, len(b)]]))
        shared = np.intersect1d(a, b)
        assert out[:, 1].tolist() == (np.searchsorted(a, shared) + 1).tolist() and out[:, 3].tolist() == (np.searchsorted(b, shared) + 1).tolist()
        assert out[0, 0] == out[0, 2] == 0 and out[1:, 0].tolist() == out[:-1, 1].tolist() and out[1:, 2].tolist() == out[:-1, 3].tolist()


def test_long_unit_without_cuts(files):
    """A text without a space or a shared end inside is one leaf, found in few rounds."""
    a, b = np.arange(2, 400_001, 2), np.append(np.arange(1, 400_000, 2), 400_000)
    assert len(align.leaves(a, b, np.array([[0, len(a), 0, len(b)]]))) == 1


def test_frames(spark, files, plain):
    texts = [*ODD, *random_texts(300)]
    rows = [(i if i % 50 else None, t, "x", "y") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, groups string, UNIT string").repartition(3)
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]
    for limit in (1, 2000, 16 << 20):
        out = align.align(docs, files, block_bytes=limit)
        assert out.columns == ["doc_id", *names]
        got = [((r.doc_id is not None, r.doc_id or 0), tuple(r)[1:]) for r in out.collect()]
        want = [((i is not None, i or 0), e) for (i, *_), e in zip(rows, expected(plain, texts))]
        assert sorted(got) == sorted(want)
    assert align.align(docs.limit(0), files).count() == 0


def test_no_row_grows_with_a_block(spark, files, monkeypatch):
    """A block of many documents is kept and shuffled in rows of a few kilobytes, and comes to the same."""
    rng = random.Random(9)
    rows = [(f"d{i}" if i else None, " ".join("".join(rng.choices("aeinorst", k=rng.randint(1, 9))) for _ in range(60))) for i in range(700)]
    docs = spark.createDataFrame(rows, "id string, text string").repartition(1)
    kept, durable = [], align.scratch.durable
    monkeypatch.setattr(align.scratch, "durable", lambda *a: kept.append(durable(*a)) or kept[-1])
    whole, parts = (align.align(docs, files, key="id", block_bytes=n) for n in (16 << 20, 20_000))
    assert [k.select("block").distinct().count() > 1 for k in kept] == [False, True]
    for k in kept:
        assert max(len(pickle.dumps(tuple(r))) for r in k.collect()) < 8192
    spread = sorted(map(str, whole.collect()))
    assert len(spread) == 700 and spread == sorted(map(str, parts.collect()))
    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    monkeypatch.setattr(align.scratch, "durable", durable)
    with settings.held(spark, limit, "7"):
        assert spread == sorted(map(str, align.align(docs, files, key="id").collect()))


def test_query(spark, folder, plain):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    out = queries.QUERIES["op11_token_alignment"](spark, folder)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    got = {r.doc_id: tuple(r)[1:] for r in out.collect()}
    for d, (*numbers, listing) in zip(docs, expected(plain, [d.text for d in docs])):
        assert got[d.doc_id] == (*numbers, hashlib.sha256(listing.encode()).hexdigest() if listing else "")
    assert out.where(F.col("n_links") < F.greatest("n_a", "n_b")).count() == 0
