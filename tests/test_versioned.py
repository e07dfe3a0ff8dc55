import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlane import scratch
from marketlane.operators import versioned
from marketlane.operators.upsert import DuplicateKeys

T0 = dt.datetime(2024, 1, 1)


def day(n):
    return T0 + dt.timedelta(days=n)


@pytest.fixture()
def table(spark):
    made = versioned.VersionedTable(spark, scratch.new_dir(spark, "versions"), ["id"])
    made.create(spark.createDataFrame([(i, f"v{i}", i) for i in range(6)], "id INT, name STRING, n INT"), T0)
    return made


def changes(spark, *rows):
    return spark.createDataFrame(list(rows), "id INT, name STRING, n INT, _op STRING")


def test_commit_read_and_time_travel(spark, table, rows):
    first = table.head()
    table.commit(changes(spark, (1, "x", 10, "U"), (2, None, None, "D"), (7, "new", 7, "U")), day(1))
    table.commit(changes(spark, (1, "y", 11, "U"), (2, "back", 2, "U")), day(2))
    assert rows(table.read()) == [
        (0, "v0", 0), (1, "y", 11), (2, "back", 2), (3, "v3", 3), (4, "v4", 4), (5, "v5", 5), (7, "new", 7),
    ]
    assert (1, "x", 10) in rows(table.read(at=day(1))) and 2 not in [r[0] for r in rows(table.read(at=day(1)))]
    assert rows(table.read(commit_id=first)) == rows(table.read(at=T0))
    with pytest.raises(versioned.UnknownVersion):
        table.read(at=day(-1))
    assert [r["operation"] for r in table.snapshots().collect()] == ["append", "append", "load"]


def test_duplicate_keys_leave_the_table_alone(spark, table, rows):
    before = rows(table.read())
    with pytest.raises(DuplicateKeys):
        table.commit(changes(spark, (1, "x", 1, "U"), (1, "y", 2, "U")), day(1))
    assert rows(table.read()) == before
    assert table.sweep() == 1  # the refused rows


def test_rollback_undoes_a_commit_and_keeps_history(spark, table, rows):
    first, before = table.head(), rows(table.read())
    second = table.commit(changes(spark, (1, "x", 1, "U")), day(1))
    table.rollback(first, day(2))
    assert rows(table.read()) == before
    history = table.history().collect()
    assert [r["commit_id"] for r in history] == [first, second, first]
    assert [r["is_current_ancestor"] for r in history] == [True, False, True]
    with pytest.raises(versioned.UnknownVersion):
        table.rollback(second, day(3))


def test_branches_are_independent_and_merge(spark, table, rows):
    table.branch("dev", day(0))
    table.branch("dev", day(0))  # exists, no effect
    table.commit(changes(spark, (1, "dev", 1, "U"), (2, None, None, "D")), day(1), "dev")
    table.commit(changes(spark, (4, "main", 4, "U")), day(1))
    assert (1, "v1", 1) in rows(table.read())
    table.merge("dev", "main", day(2))
    assert rows(table.read()) == [(0, "v0", 0), (1, "dev", 1), (3, "v3", 3), (4, "main", 4), (5, "v5", 5)]
    merged = table.head()
    assert table.merge("dev", "main", day(3)) == merged == table.head()  # nothing new
    table.commit(changes(spark, (1, "dev2", 1, "U")), day(4), "dev")
    table.merge("dev", "main", day(5))  # main got key 1 from dev, so this is no conflict
    assert (1, "dev2", 1) in rows(table.read()) and (4, "main", 4) in rows(table.read())
    table.commit(changes(spark, (4, "dev", 4, "U")), day(6), "dev")
    with pytest.raises(versioned.MergeConflict):  # dev never saw main's key 4
        table.merge("dev", "main", day(7))


def test_fast_forward_and_nothing_to_do(spark, table):
    table.branch("dev", day(0))
    assert table.merge("dev", "main", day(1)) == table.head()
    moved = table.commit(changes(spark, (1, "dev", 1, "U")), day(1), "dev")
    assert table.merge("dev", "main", day(2)) == moved == table.head()


def test_merge_refuses_keys_changed_on_both_sides(spark, table):
    table.branch("dev", day(0))
    table.commit(changes(spark, (1, "dev", 1, "U")), day(1), "dev")
    table.commit(changes(spark, (1, "main", 1, "U")), day(1))
    with pytest.raises(versioned.MergeConflict):
        table.merge("dev", "main", day(2))


def test_tags_do_not_move(spark, table, rows):
    table.tag("v1", day(0))
    table.commit(changes(spark, (1, "x", 1, "U")), day(1))
    assert (1, "v1", 1) in rows(table.read("v1"))
    with pytest.raises(ValueError):
        table.commit(changes(spark, (1, "x", 1, "U")), day(1), "v1")
    assert rows(table.refs("tag"), "name") == [("v1",)]
    table.drop("v1", day(2))
    assert rows(table.refs(), "name") == [("main",)]
    with pytest.raises(versioned.UnknownVersion):
        table.read("v1")


def test_schema_evolution(spark, table, rows):
    before = table.head()
    table.add_columns("score INT", day(1))
    assert rows(table.read(), "score") == [(None,)] * 6
    table.commit(table.read().where("id = 1").withColumn("score", F.lit(5)), day(2))
    assert rows(table.read().where("score IS NOT NULL"), "id", "score") == [(1, 5)]
    with_score = table.head()
    table.drop_column("score", day(3))
    assert "score" not in table.read().columns and "score" in table.read(commit_id=with_score).columns
    table.add_columns("score BIGINT", day(4))  # the old values stay dropped
    assert rows(table.read(), "score") == [(None,)] * 6
    table.widen_column("n", "bigint", day(5))
    table.rename_column("name", "label", day(6))
    assert table.read().columns == ["id", "label", "n", "score"]
    assert dict(table.read().dtypes)["n"] == "bigint"
    table.add_columns("n_copy DOUBLE", day(7), copy_from={"n_copy": "n"})
    table.commit(table.read().where("id = 0").withColumn("n", F.lit(2**40)), day(8))
    assert rows(table.read().where("id < 2"), "id", "n", "n_copy") == [(0, 2**40, float(2**40)), (1, 1, 1.0)]
    assert table.read(commit_id=before).columns == ["id", "name", "n"]
    with pytest.raises(ValueError):
        table.drop_column("id", day(9))


def test_compaction_keeps_contents_and_older_versions(spark, table, rows):
    table.commit(changes(spark, (1, "x", 1, "U"), (2, None, None, "D")), day(1))
    before = rows(table.read())
    table.compact(day(2))
    assert rows(table.read()) == before
    assert len(rows(table.read(at=T0))) == 6
    table.commit(changes(spark, (8, "z", 8, "U")), day(3))
    assert len(rows(table.read())) == len(before) + 1


def test_compacted_branch_can_still_merge(spark, table, rows):
    table.branch("dev", day(0))
    table.commit(changes(spark, (1, "dev", 1, "U")), day(1), "dev")
    table.compact(day(2), "dev")
    table.commit(changes(spark, (4, "main", 4, "U")), day(1))
    table.merge("dev", "main", day(3))
    assert (1, "dev", 1) in rows(table.read()) and (4, "main", 4) in rows(table.read())


def test_expiry_keeps_every_ref_readable(spark, table, rows):
    table.tag("v1", day(0))
    for n in range(1, 5):
        table.commit(changes(spark, (n, f"c{n}", n, "U")), day(n))
    now, tagged, third = rows(table.read()), rows(table.read("v1")), rows(table.read(at=day(3)))
    gone = table.expire(day(3))
    assert len(gone) == 2  # days 1 and 2; the tagged load stays
    assert table.sweep() == 3  # their files, and the changes of day 3 now held by its base
    assert rows(table.read()) == now and rows(table.read("v1")) == tagged and rows(table.read(at=day(3))) == third
    with pytest.raises(versioned.UnknownVersion):
        table.read(commit_id=gone[0])


def test_a_batch_is_merged_once(spark, table, rows):
    source = spark.createDataFrame([(1, "s", 1), (9, "s", 9)], "id INT, name STRING, n INT")
    first = table.merge_rows(source, day(1), ["name"], batch="b-1")
    assert table.merge_rows(source, day(2), ["name"], batch="b-1") == first
    assert rows(table.read().where("name = 's'"), "id") == [(1,), (9,)]
