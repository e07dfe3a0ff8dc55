"""Stored tables whose columns grow: added columns read NULL in files written before, and no file is rewritten.

Parquet columns are found by name, so a folder may hold files of several widths
and is read by the widest schema; a query that names the old columns opens no
other, whatever was added since.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlane import scratch


@dataclass(frozen=True)
class Growing:
    spark: SparkSession
    path: str
    schema: T.StructType

    @property
    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)


def store(rows: DataFrame, label: str) -> Growing:
    path = scratch.new_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    return Growing(rows.sparkSession, path, rows.schema)


def add_columns(table: Growing, columns: dict[str, str]) -> Growing:
    """The table with columns (name -> type) added; a name that differs from a present one in case only clashes too."""
    taken = {name.lower() for name in table.schema.names}
    clash = [c for c in columns if c.lower() in taken]
    if clash:
        raise ValueError(f"columns already there: {', '.join(clash)}")
    added = T.DataType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in columns.items()))
    return Growing(table.spark, table.path, T.StructType([*table.schema.fields, *added.fields]))


def append(table: Growing, rows: DataFrame) -> None:
    """Add rows by name; columns they lack are NULL, others than the table's are refused."""
    known = {f.name.lower(): f for f in table.schema.fields}
    unknown = [c for c in rows.columns if c.lower() not in known]
    if unknown:
        raise ValueError(f"columns not in the table: {', '.join(unknown)}")
    given = {c.lower(): F.col(c) for c in rows.columns}
    picked = [given.get(k, F.lit(None)).cast(f.dataType).alias(f.name) for k, f in known.items()]
    rows.select(*picked).write.mode("append").parquet(table.path)
