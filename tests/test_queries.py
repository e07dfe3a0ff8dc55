"""Every registered query against its SQL, and those without SQL for rows and stable columns."""

import pytest
from oracle import connect, difference

import __spark_entry__ as entry_module
from marketlane import registry


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_equals_sql(spark, folder, duck, name):
    assert difference(registry.QUERIES[name](spark, folder), duck, registry.ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_gives_rows(spark, folder, name):
    df = registry.QUERIES[name](spark, folder)
    assert df.columns and df.count() > 0


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_file_counts_drop_by_compaction(spark, folder):
    listed = {r["layout"]: r for r in registry.QUERIES["m1_compaction_files"](spark, folder).collect()}
    assert not listed["scattered"]["few_files"] and listed["compacted"]["few_files"]
    assert listed["scattered"]["record_count"] == listed["compacted"]["record_count"]


def test_files_are_snappy(spark, folder):
    assert [r["snappy"] for r in registry.QUERIES["b10_file_properties"](spark, folder).collect()] == [True]
