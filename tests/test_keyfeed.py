import datetime as dt
import random

import pytest

from marketlane import scratch
from marketlane.streaming import continuous, keyfeed

DDL = "id INT, version INT, v STRING"


@pytest.fixture()
def feed(spark):
    base = spark.createDataFrame([(i, 10, f"b{i}") for i in range(40)] + [(None, 1, "loose")], DDL)
    return keyfeed.start(base, ["id"], "version", buckets=4)


def _batches(spark, inbox, batches):
    for batch in batches:
        spark.createDataFrame(batch, DDL).coalesce(1).write.mode("append").parquet(inbox)


def _listen(spark, feed, inbox, checkpoint, per_batch=1):
    stream = continuous.arriving_files(spark, inbox, DDL, files_per_batch=per_batch)
    query = keyfeed.listen(feed, stream, checkpoint)
    query.awaitTermination()
    return [p["numInputRows"] for p in query.recentProgress]


def _expected(batches):
    """Brute force: row by row, a newer version wins, of equally new ones the larger value."""
    held = {i: (10, f"b{i}") for i in range(40)}
    for key, *new in (r for b in batches for r in b if r[0] is not None):
        held[key] = max(held.get(key, (-1, "")), tuple(new))
    loose = {(None, 1, "loose")} | {r for b in batches for r in b if r[0] is None}
    return sorted([(k, *v) for k, v in held.items()]) + sorted(loose)


def _got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r))


def _random(seed, n):
    deal = random.Random(seed)
    rows = [[(deal.randrange(60), deal.randrange(30), deal.choice("xyz")) for _ in range(20)] for _ in range(n)]
    rows[0] += [(None, 5, "no key"), (None, 5, "no key"), (None, 6, "no key")]
    return rows


def test_batches_in_any_order_equal_row_by_row(spark, feed):
    inbox, state = scratch.new_dir(spark, "in"), scratch.new_dir(spark, "ck")
    batches = _random(1, 4)
    _batches(spark, inbox, batches)
    _listen(spark, feed, inbox, state)
    assert _got(keyfeed.current(feed)) == _expected(batches)
    _batches(spark, inbox, [[(3, 99, "new"), (3, 98, "old"), (3, 99, "newer")]])
    _listen(spark, feed, inbox, state)
    assert (3, 99, "newer") in _got(keyfeed.current(feed))
    _batches(spark, inbox, [[(3, 50, "late")]])
    _listen(spark, feed, inbox, state)
    assert (3, 99, "newer") in _got(keyfeed.current(feed))


def test_folds_and_lost_checkpoints_change_nothing(spark, feed):
    inbox, state = scratch.new_dir(spark, "in"), scratch.new_dir(spark, "ck")
    batches = _random(2, 3)
    _batches(spark, inbox, batches)
    _listen(spark, feed, inbox, state)
    before = _got(keyfeed.current(feed))
    folded = keyfeed.fold(feed)
    assert scratch.finished(spark, folded.changes) == []
    assert _got(folded.base.rows) == before == _got(keyfeed.current(folded)) == _expected(batches)
    _listen(spark, folded, inbox, scratch.new_dir(spark, "ck"))  # reads every file again
    assert _got(keyfeed.current(folded)) == before
    more = _random(3, 2)
    _batches(spark, inbox, more)
    _listen(spark, folded, inbox, state)  # the first checkpoint goes on after the fold
    assert _got(keyfeed.current(keyfeed.fold(folded))) == _expected(batches + more)


def test_a_batch_writes_only_keys_that_arrived(spark, feed):
    inbox = scratch.new_dir(spark, "in")
    _batches(spark, inbox, [[(i, 20, "a") for i in range(30)], [(7, 21, "b"), (7, 22, "c")], [(8, 1, "late")]])
    assert _listen(spark, feed, inbox, scratch.new_dir(spark, "ck"))
    sizes = [spark.read.parquet(p).count() for p in scratch.finished(spark, feed.changes)]
    assert sorted(sizes) == [0, 1, 1, 30]


def test_the_base_is_not_shuffled(spark, feed):
    inbox = scratch.new_dir(spark, "in")
    _batches(spark, inbox, [[(1, 20, "a")]])
    _listen(spark, feed, inbox, scratch.new_dir(spark, "ck"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = keyfeed.current(feed)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    join = plan[plan.index("SortMergeJoin") :].splitlines()
    scan = next(k for k, line in enumerate(join) if "Bucketed: true" in line)
    arrivals = next(k for k, line in enumerate(join) if "Exchange" in line)
    assert scan < arrivals, plan


def test_empty_tables_and_settings(spark):
    feed = keyfeed.start(spark.createDataFrame([], DDL), ["id"], "version", buckets=2)
    inbox = scratch.new_dir(spark, "in")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    assert keyfeed.current(feed).count() == 0 == keyfeed.fold(feed).base.rows.count()
    _batches(spark, inbox, [[(1, None, "no version"), (1, 2, "b"), (2, None, None)]])
    feed = keyfeed.start(spark.createDataFrame([], DDL), ["id"], "version", buckets=2)
    _listen(spark, feed, inbox, scratch.new_dir(spark, "ck"))
    assert _got(keyfeed.current(feed)) == [(1, 2, "b"), (2, None, None)]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before


def test_moments_as_versions(spark):
    ddl = "id INT, at TIMESTAMP_NTZ, v STRING"
    day = [dt.datetime(2001, 1, d) for d in (1, 2, 3)]
    feed = keyfeed.start(spark.createDataFrame([(1, day[1], "b")], ddl), ["id"], "at", buckets=2)
    inbox = scratch.new_dir(spark, "in")
    spark.createDataFrame([(1, day[0], "a"), (2, day[0], "n")], ddl).write.parquet(inbox)
    keyfeed.listen(feed, continuous.arriving_files(spark, inbox, ddl), scratch.new_dir(spark, "ck")).awaitTermination()
    assert _got(keyfeed.current(feed)) == [(1, day[1], "b"), (2, day[0], "n")]
