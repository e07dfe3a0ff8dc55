"""Personal data against plain patterns, and what the labelers add."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from marketlane.llm import personal, queries


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def plain(text):
    text, out = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return ",".join(f"{personal.BASE[k]}:{a}:{b}" for a, k, b in sorted(out))


ODD = [
    None, "", "a@b", "a@b.c@d.e", "a@b.com_x@y.zz", "x..y@z..a.b@c.d", "a@-.-", "1.2.3.4.5.6.7.8", "1.2.3x4.5.6.7", "256.1.1.1 0255.0.0.001",
    "999999999999999999999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1111-4111", "4111  1111 1111 1111", "+1 (555) 123-4567", "+1+2 345 678 90",
    "+123 456 789 ", "++49 30 123456", "é😀 jo@ex.org 😀 10.0.0.1", "\n+1 555\n123 4567", "v 1.2.3.4 a@b.co",
]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")


def base_of(found):
    base = F.filter("spans", lambda s: s["base"])
    return {r.doc_id: r.b for r in found.select("doc_id", personal.listing(base).alias("b")).collect()}


def test_base_spans_of_odd_and_random_texts(spark):
    rng = random.Random(6)
    bits = ["a@", "b.co", "@c-d.e", "..", ".", "1", "25", "255.", "4111", " ", "-", "+", "+1", "(", ")", "x", "é", "😀", "\n", "1111111111111", "@"]
    texts = ODD + ["".join(rng.choices(bits, k=rng.randint(1, 40))) for _ in range(1500)]
    got = base_of(personal.find(frame(spark, texts)))
    for i, t in enumerate(texts):
        assert got[i] == plain(t), t


def test_long_texts_take_no_long(spark):
    n = 200_000
    texts = ["a" * n, "1" * n, "a@" + "b." * n, "1." * n, "+" * n, "+1" + " " * n, "a@b.c " * (n // 50), "1 " * n]
    got = base_of(personal.find(frame(spark, texts)))
    assert got[6] == plain(texts[6]) and got[0] == got[4] == "" and got[3] == plain(texts[3])


def test_query(spark):
    path = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    out = queries.QUERIES["op7_personal_data"](spark, path).collect()
    assert len(out) == len(texts)
    for r in out:
        want = plain(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in personal.BASE] == [want.count(k + ":") for k in personal.BASE]
        assert not want or set(want.split(",")) <= set(r.spans.split(","))


def test_labelers_add_spans_and_base_stays(spark):
    extra = ["write to jo (at) mail (dot) com", "call 555-234-9876 now", "token = \"0123456789abcdef01\"", "my ssn 123-45-6789"]
    clean = ["version 1.2 of 2001-02-03, page 12 of 345", "isbn 978-3-16-148410-0", "total 1,234.56", "no numbers at all (at) home"]
    docs = frame(spark, (extra + clean) * 30 + ["mail a@b.org", "ip 10.1.2.3"] * 30)
    found = personal.find(docs)
    assert found.columns == ["doc_id", "spans"]
    got = {r.doc_id: [s.kind for s in r.spans] for r in found.collect()}
    assert [got[i] for i in range(4)] == [["email"], ["phone"], ["secret"], ["id"]]
    assert [got[i] for i in range(4, 8)] == [[], [], [], []]


def test_reliabilities_tell_good_labelers_from_bad():
    rng = random.Random(2)
    truth = [0.95, 0.9, 0.6, 0.85, 0.8, 0.55]
    counts = {}
    for _ in range(20_000):
        y = 1 if rng.random() < 0.6 else -1
        number = 0
        for right in truth:
            vote = 0 if rng.random() < 0.2 else y if rng.random() < right else -y
            number = number * 3 + vote + 1
        counts[number] = counts.get(number, 0) + 1
    chance, found = personal.reliabilities(counts)
    assert all(abs(a - b) < 0.04 for a, b in zip(found, truth))
    assert all(0 <= p <= 1 for p in chance.values())
    assert personal.reliabilities({})[0] == {}


def test_empty_table(spark):
    assert personal.find(frame(spark, ["x"]).limit(0)).count() == 0


@pytest.mark.parametrize("digits", ["4111111111111111", "79927398713", "79927398710", "0", "18"])
def test_luhn(spark, digits):
    assert spark.range(1).select(personal.luhn(F.lit(digits)).alias("ok")).first().ok == luhn(digits)


def test_long_credentials_and_addresses_are_whole(spark):
    rng = random.Random(9)
    token = "eyJ" + "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-.", k=297)).replace("..", "x.") + "Z"
    token = re.sub("[0-9]+", lambda m: m[0][:1], token)
    local, label = "a" * 80, "b" * 70
    mail = f"{local} (at) {label}" + " (dot) c" * 7 + " (dot) com"
    texts = [f"use token={token} here", f"write to {mail}.", f"password: {'p' + 'q7' * 2_500}\n"]
    spans = {r.doc_id: r.spans for r in frame(spark, texts).select("doc_id", personal.candidates(frame(spark, texts)).alias("spans")).collect()}
    for i, (text, value, kind) in enumerate(zip(texts, [token, mail, "p" + "q7" * 2_500], ["secret", "email", "secret"])):
        start = text.index(value)
        assert [(s.start, s.end, personal.KINDS[s.kind]) for s in spans[i]] == [(start, start + len(value), kind)]
    found = {r.doc_id: [(s.kind, s.end) for s in r.spans] for r in personal.find(frame(spark, texts)).collect()}
    assert found[0] == [("secret", len("use token=") + len(token))]


def test_many_spans_in_one_text(spark):
    """Spans across several chunks, and columns that could clash."""
    text = " ".join(f"mail a{i}@ex{i}.com or call (555) 123-{i + 1000}, ok" for i in range(700))
    docs = spark.createDataFrame([(1, text, 5)], "doc_id long, text string, SPANS int")
    (row,) = personal.find(docs).collect()
    base = [(s["start"], s["end"]) for s in row["spans"] if s["base"]]
    want = [m.span() for m in re.finditer(r"a[0-9]+@ex[0-9]+\.com", text)]
    assert base == want
    assert [(s["start"], s["end"]) for s in row["spans"] if not s["base"]] == [m.span() for m in re.finditer(r"\(555\) 123-[0-9]+", text)]
