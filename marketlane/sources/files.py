"""CSV, Parquet and JSON files in and out, and the stamps put on ingested rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlane import scratch
from marketlane.functions.columns import ts_lit
from marketlane.sources import quoted

# Text keeps its padding both ways; the cleaning step is what trims it. A quote inside quotes is doubled.
_CSV = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}
MALFORMED = "_malformed"
_ORIGIN = "_origin"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    line_breaks: bool | None = None,
    malformed: bool = False,
    origin: str | None = None,
) -> DataFrame:
    """CSV with a header line. Without a schema the types are inferred, at the cost of a pass over the files.

    Line breaks inside quotes are part of the value. Unless ``line_breaks``
    says whether there are any, the lines are searched for it. Files are read
    split by split either way (see ``quoted``); only inferring types from files
    with such values reads each by one task. With a schema, ``malformed`` adds
    a column with the text of each record that does not fit it; the fields that
    fit keep their values. ``origin`` names a column for the file's name.
    """
    if line_breaks is None:
        line_breaks = quoted.has_line_breaks(spark, path)
    if schema is None and line_breaks:
        schema = spark.read.options(**_CSV).option("multiLine", "true").option("inferSchema", "true").csv(path).schema
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if line_breaks:
        rows = quoted.read(spark, path, schema, _CSV, MALFORMED if malformed else None)
        name = F.element_at(F.split(F.col(quoted.FILE), "/"), -1)
        return (rows if origin is None else rows.withColumn(origin, F.url_decode(name))).drop(quoted.FILE)
    reader = spark.read.options(**_CSV)
    if schema is None:
        rows = reader.option("inferSchema", "true").csv(path)
    else:
        if malformed:
            schema = T.StructType([*schema, T.StructField(MALFORMED, T.StringType())])
            reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", MALFORMED)
        rows = reader.schema(schema).option("enforceSchema", "false").csv(path)
    return rows if origin is None else rows.withColumn(origin, F.col("_metadata.file_name"))


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(**_CSV).mode("overwrite").csv(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Snappy Parquet. A partitioned write first gathers each partition's rows.

    ``rebalance`` does that by size: a partition value holding most of the rows
    is written by several tasks, while small values share one.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.mode("overwrite").option("compression", "snappy").partitionBy(*partition_by).parquet(path)


def write_json_report(report: DataFrame, path: str) -> None:
    """A one-row report as a JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def report_document(report: DataFrame) -> DataFrame:
    """Each report row as one JSON text."""
    return report.select(F.to_json(F.struct(*report.columns)).alias("document"))



def stamped(df: DataFrame, now: dt.datetime | None = None, source_file: Column | None = None) -> DataFrame:
    """Adds arrival time, file of origin and the initial quality mark to rows read from files."""
    arrived = F.localtimestamp() if now is None else ts_lit(now)
    origin = F.col("_metadata.file_name") if source_file is None else source_file
    return df.select(
        "*",
        arrived.alias("ingested_at"),
        origin.alias("source_file"),
        F.lit("pending").alias("data_quality_flag"),
    )


def ingest(
    spark: SparkSession,
    csv_path: str,
    out_path: str,
    schema: T.StructType | str,
    date_columns: tuple[str, ...] = (),
    now: dt.datetime | None = None,
    rejects_path: str | None = None,
    line_breaks: bool | None = None,
) -> DataFrame:
    """CSV to the raw layer: dates parsed from text, stamps added, written as Parquet and read back.

    ``schema`` gives the CSV columns, with date columns as STRING. Records that
    do not fit it are written to ``rejects_path`` with their text and are no
    part of the layer; without that path a malformed record is an error.
    """
    found = read_csv(spark, csv_path, schema, line_breaks, malformed=True, origin=_ORIGIN)
    read = stamped(found, now, F.col(_ORIGIN)).drop(_ORIGIN)
    read = read.withColumns({c: F.try_to_date(F.col(c)) for c in date_columns})
    if rejects_path is None:
        refused = F.raise_error(F.concat(F.lit("malformed record: "), F.col(MALFORMED)))
        kept = F.when(F.col(MALFORMED).isNotNull(), refused.cast("string")).otherwise(F.col("data_quality_flag"))
        rows = read.withColumn("data_quality_flag", kept).drop(MALFORMED)
    else:
        held = scratch.durable(read, "ingest")
        write_parquet(held.where(F.col(MALFORMED).isNotNull()), rejects_path)
        rows = held.where(F.col(MALFORMED).isNull()).drop(MALFORMED)
    write_parquet(rows, out_path)
    return spark.read.schema(rows.schema).parquet(out_path)
