"""Catalog tables: namespaces, declared tables, create-as-select and inserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlane import schemas
from marketlane.settings import held


def create_namespaces(spark: SparkSession, root: str, names: list[str]) -> list[str]:
    """Create each namespace below ``root``; returns those that could not be created."""
    failed = []
    for name in names:
        try:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{root}/{name}'")
        except Exception:  # one bad namespace must not stop the others
            failed.append(name)
    return failed


def create_table(
    spark: SparkSession, table: str, ddl: str, partition_by: tuple[str, ...] = (), path: str | None = None
) -> None:
    """Declare an empty Parquet table unless it exists."""
    clauses = [f"CREATE TABLE IF NOT EXISTS {table} ({ddl}) USING parquet"]
    clauses.append("OPTIONS ('compression' = 'snappy')")
    if partition_by:
        clauses.append(f"PARTITIONED BY ({', '.join(partition_by)})")
    if path:
        clauses.append(f"LOCATION '{path}'")
    spark.sql(" ".join(clauses))


def create_all(spark: SparkSession, namespace_suffix: str = "") -> list[str]:
    """Declare every table of the three layers; returns their names."""
    made = []
    for name, (ddl, partitions) in schemas.TABLES.items():
        layer, table = name.split(".")
        full = f"{layer}{namespace_suffix}.{table}"
        create_table(spark, full, ddl, partitions)
        made.append(full)
    return made


def _gathered(df: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def replace_table(
    df: DataFrame, table: str, partition_by: tuple[str, ...] = (), path: str | None = None
) -> None:
    """Create the table from ``df``, replacing one of that name and its layout."""
    writer = _gathered(df, partition_by).write.mode("overwrite").format("parquet").partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def create_as_select(df: DataFrame, table: str, partition_by: tuple[str, ...] = ()) -> bool:
    """Create the table from ``df`` unless it exists; tells whether it did."""
    if df.sparkSession.catalog.tableExists(table):
        return False
    replace_table(df, table, partition_by)
    return True


def insert(df: DataFrame, table: str) -> None:
    """Append rows, matched to the table's columns by name.

    ``insertInto`` goes by position, so the columns are put in the table's order first.
    """
    spark = df.sparkSession
    df.select(*spark.table(table).columns).write.insertInto(table, overwrite=False)


def insert_overwrite(df: DataFrame, table: str) -> None:
    """Replace only the partitions that occur in ``df``; running it again changes nothing."""
    spark = df.sparkSession
    columns = spark.table(table).columns
    with held(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        df.select(*columns).write.insertInto(table, overwrite=True)


def scan(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)
