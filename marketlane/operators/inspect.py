"""What a stored table consists of: files, partitions, columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BYTES_PER_MB = 1024.0 * 1024.0


def files(df: DataFrame) -> DataFrame:
    """One row per data file: path, size in MB, rows. Reads no data column."""
    return (
        df.select("_metadata.file_path", "_metadata.file_size")
        .groupBy("file_path", "file_size")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .select(
            "file_path",
            F.round(F.col("file_size") / F.lit(BYTES_PER_MB), 2).alias("size_mb"),
            F.col("file_size").alias("file_size_in_bytes"),
            "record_count",
        )
    )


def ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per data file: path, rows, and the least and greatest value of each column. Store it beside the files."""
    spans = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    return df.groupBy("_metadata.file_path").agg(F.count(F.lit(1)).alias("record_count"), *spans)


def largest_files(df: DataFrame, k: int = 20) -> DataFrame:
    return (
        files(df)
        .orderBy(F.col("file_size_in_bytes").desc(), "file_path")
        .limit(k)
        .select("file_path", "size_mb", "record_count")
    )


def partition_stats(df: DataFrame, partition_by: list[Column | str]) -> DataFrame:
    """Rows, files and bytes per partition value.

    Rows are counted per file first, so a partition with most of the rows
    reaches the second step as one row per file.
    """
    per_file = df.groupBy(*partition_by, "_metadata.file_path", "_metadata.file_size").agg(
        F.count(F.lit(1)).alias("rows")
    )
    names = [c for c in per_file.columns if c not in ("file_path", "file_size", "rows")]
    return per_file.groupBy(*names).agg(
        F.sum("rows").alias("record_count"),
        F.count(F.lit(1)).alias("file_count"),
        F.sum("file_size").alias("total_bytes"),
    )


def describe(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Columns of a frame as rows: position, name, type."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position INT, col_name STRING, data_type STRING")
