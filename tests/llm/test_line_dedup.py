"""Line dedup against SQL, and that deletion undoes insertion."""

import random

import numpy as np
import pytest
import xxhash
from oracle import connect, difference

from marketlane.llm import cuckoo, line_dedup, queries


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_equals_sql(spark, sf):
    path = f"/root/testdata/{sf}"
    df = queries.QUERIES["op2_line_dedup"](spark, path)
    assert difference(df, connect(path), queries.ORACLES["op2_line_dedup"]) is None


def digests(n, seed=0):
    return cuckoo.as_digests([xxhash.xxh3_128_digest(f"{seed}-{i}") for i in range(n)])


def test_cuckoo_holds_all_and_forgets_removed():
    f = cuckoo.Filter()
    mine, other = digests(3000), digests(20_000, 1)
    f.insert(mine)
    f = cuckoo.Filter(f.to_bytes())
    assert f.contains(mine).all()
    assert f.contains(other).mean() < 0.01
    f.remove(mine[:2000])
    assert f.contains(mine[2000:]).all()
    assert f.contains(mine[:2000]).mean() < 0.05
    f.remove(mine[2000:])
    assert not f.contains(mine).any()
    assert not cuckoo.Filter().contains(np.zeros((2, 2), np.uint64)).any()


ROWS = [
    (1, "Same Line\nown 1", "x"), (2, " same line\t\nown 2\n", "x"), (3, "SAME LINE", None), (3, "SAME LINE", None), (None, "same line\r", "n"),
    (4, None, "y"), (5, "", "y"), (6, "\n \n", "y"), (7, "same line\nsame line\nÉ", "z"), (8, "é", "z"),
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, n_lines string")


def test_edges_and_columns(spark, rows):
    docs = frame(spark, ROWS)
    out = line_dedup.drop(docs, line_dedup.build(docs, 4))
    assert out.columns == ["doc_id", "text", "n_lines", "n_dropped"]
    got = rows(out, "doc_id", "text", "n_lines", "n_dropped")
    assert got == sorted(
        [
            (1, "own 1", 2, 1), (2, "own 2\n", 3, 1), (3, "", 1, 1), (3, "", 1, 1), (None, "", 1, 1), (4, "", 1, 0), (5, "", 1, 0),
            (6, "\n \n", 3, 0), (7, "É", 3, 2), (8, "é", 1, 0),
        ],
        key=lambda t: [(v is not None, v) for v in t],
    )


def test_deletion_undoes_insertion(spark):
    rng = random.Random(4)
    lines = [f"line {i}" for i in range(40)]
    texts = ["\n".join(rng.choices(lines, k=6)) for _ in range(60)]
    first, second = frame(spark, [(i, t, "") for i, t in enumerate(texts[:40])]), frame(spark, [(i, t, "") for i, t in enumerate(texts[40:])])

    def counts(store):
        return {bytes(r.key): r.refs for r in store.refs.collect()}

    def kept(store):
        return sorted(r.text for r in line_dedup.drop(first, store).collect())

    one = line_dedup.build(first, 7)
    both = line_dedup.insert(one, second)
    assert counts(both) == counts(line_dedup.build(first.union(second), 7))
    assert kept(both) == kept(line_dedup.build(first.union(second), 7)) != kept(one)
    back = line_dedup.delete(both, second)
    assert counts(back) == counts(one) and kept(back) == kept(one)
    assert counts(line_dedup.delete(one, first)) == {}


def test_empty_table(spark):
    none = frame(spark, [])
    assert line_dedup.drop(none, line_dedup.build(none, 2)).count() == 0
    some = frame(spark, ROWS)
    assert line_dedup.drop(some, line_dedup.build(none, 2)).where("n_dropped > 0").count() == 0


def test_removal_takes_no_other_key():
    """Of 60,000 keys in chained tables half are removed; none of the rest is missed."""
    import xxhash

    raw = [xxhash.xxh3_128_digest(str(k).encode()) for k in range(60_000)]
    held = cuckoo.Filter()
    held.insert(cuckoo.as_digests(raw))
    held.remove(cuckoo.as_digests(raw[::2]))
    assert len(held.tables) > 1 and held.contains(cuckoo.as_digests(raw[1::2])).all()
    assert held.contains(cuckoo.as_digests(raw[::2])).mean() < 0.02


def test_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a\nb", 1, 2, 3, 4)], "doc_id long, text string, _id int, _keys int, _out int, N_LINES int")
    out = line_dedup.drop(docs, line_dedup.build(docs.select("doc_id", "text"), 1))
    assert out.columns == ["doc_id", "text", "_id", "_keys", "_out", "n_lines", "n_dropped"]
    assert [tuple(r) for r in out.collect()] == [(1, "", 1, 2, 3, 2, 2)]
