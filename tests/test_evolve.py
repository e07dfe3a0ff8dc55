"""Columns added to a stored table: old files stay, old and new rows are read by one schema."""

import pytest
from pyspark.sql import functions as F

from marketlane.operators import evolve, inspect


def test_added_columns_rewrite_nothing(spark, rows):
    table = evolve.store(spark.createDataFrame([(1, "a"), (2, None)], "k INT, v STRING"), "growing")
    before = {r["file_path"] for r in inspect.files(table.rows).collect()}
    wide = evolve.add_columns(table, {"score": "int", "day": "date"})
    assert rows(wide.rows) == [(1, "a", None, None), (2, None, None, None)]
    evolve.append(wide, spark.createDataFrame([(7, 3, "c")], "score BIGINT, K INT, v STRING"))
    assert rows(wide.rows, "k", "v", "score") == [(1, "a", None), (2, None, None), (3, "c", 7)]
    assert before < {r["file_path"] for r in inspect.files(wide.rows).collect()}
    # The schema of before still reads every row.
    assert rows(table.rows) == [(1, "a"), (2, None), (3, "c")]


def test_old_projection_reads_its_columns_only(spark):
    table = evolve.add_columns(evolve.store(spark.range(5).withColumn("v", F.lit(1.5)), "growing"), {"more": "string"})
    plan = table.rows.select("id")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan


def test_clashing_and_unknown_columns_are_refused(spark):
    table = evolve.store(spark.range(1), "growing")
    with pytest.raises(ValueError):
        evolve.add_columns(table, {"ID": "int"})
    with pytest.raises(ValueError):
        evolve.append(table, spark.range(1).withColumn("extra", F.lit(1)))
