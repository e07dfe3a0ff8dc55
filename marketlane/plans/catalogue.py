"""Data kept about the tables: version statistics, audit trail, namespace properties."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlane.functions.columns import ts_lit
from marketlane.operators.joins import insert_absent


def table_versions(snapshots: DataFrame, namespace: str, table: str) -> DataFrame:
    """A table's commits in the shape of the table registry."""
    return snapshots.select(
        F.lit(namespace).alias("table_namespace"),
        F.lit(table).alias("table_name"),
        F.col("commit_id").alias("version"),
        F.col("committed_at").alias("last_updated"),
    )


def table_stats(versions: DataFrame) -> DataFrame:
    """Number of versions and last change per table; running it again is the refresh."""
    return versions.groupBy("table_namespace", "table_name").agg(
        F.count(F.lit(1)).alias("version_count"), F.max("last_updated").alias("last_modified")
    )


def audit_entries(
    rows: DataFrame, table: str | Column, operation: str | Column, user: str, now: dt.datetime, details: list[str]
) -> DataFrame:
    """Audit rows with the ``details`` columns as JSON text. Append them to the stored trail."""
    as_column = [F.lit(c) if isinstance(c, str) else c for c in (table, operation)]
    return rows.select(
        as_column[0].alias("table_name"),
        as_column[1].alias("operation"),
        F.lit(user).alias("username"),
        ts_lit(now).alias("timestamp"),
        F.to_json(F.struct(*details)).alias("details"),
    )


def set_absent_properties(properties: DataFrame, wanted: DataFrame) -> DataFrame:
    """Namespace properties with the ``wanted`` ones added where the key is not set yet."""
    return insert_absent(properties, wanted, ["catalog_name", "namespace", "property_key"])
