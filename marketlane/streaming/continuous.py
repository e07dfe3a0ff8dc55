"""Orders arriving as files, upserted batch by batch."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlane import scratch
from marketlane.operators.upsert import newest_per_key
from marketlane.operators.versioned import VersionedTable


def arriving_files(
    spark: SparkSession, folder: str, schema: str, files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def upsert_stream(
    stream: DataFrame,
    table: VersionedTable,
    update: list[str],
    checkpoint: str,
    version_by: str,
    ref: str = "main",
    clock: Callable[[], dt.datetime] | None = None,
) -> StreamingQuery:
    """Process everything that has arrived, one commit per batch that changes rows.

    The stream's checkpoint takes the place of the high-water mark. A row is
    changed only by a newer version (``version_by``), so a replayed batch, a
    new checkpoint that reads all files again, and versions that arrive late
    change nothing, and no batch is skipped by its number. Of several versions
    of a key in one batch the newest counts. A commit is dated by the batch's
    newest version or ``clock``, but no earlier than the commit before.
    """

    def write(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        with scratch.held(newest_per_key(batch, table.keys, version_by), "batch") as latest:
            moment = clock() if clock else latest.agg(F.max(version_by)).first()[0]
            table.merge_rows(latest, moment, update, ref=ref, newer_by=version_by)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
