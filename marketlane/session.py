"""Spark session used by the tests and the benchmark.

On a cluster the caller brings its own session; nothing in the library
depends on the settings below for right results.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(cores: int | str = "*", app: str = "marketlane", **extra: str) -> SparkSession:
    partitions = str(cores) if str(cores).isdigit() else "8"
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": partitions,
        # Test tables are small: let a few hundred kilobytes still use all cores.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        # Many different plans run in one session; keep their generated classes.
        "spark.sql.codegen.cache.maxEntries": "4000",
        **extra,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
