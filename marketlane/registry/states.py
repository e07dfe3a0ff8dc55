"""Stored tables that several registered queries read: two loads of orders and their versions."""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlane import scratch
from marketlane.functions.columns import not_cancelled, ts_lit
from marketlane.operators import keyed, timeline
from marketlane.operators.upsert import require_unique
from marketlane.operators.versioned import DELETE, UPSERT, VersionedTable
from marketlane.registry.base import CUT, NOW
from marketlane.registry.reference_sql import CTES
from marketlane.sources import adapters

RESEND_FROM = dt.date(2000, 11, 2)
DEV_AT = dt.datetime(2001, 3, 1)
MERGED_AT = dt.datetime(2001, 8, 3)
DEV_BEFORE = dt.date(1996, 1, 1)
DELIVERED_FROM = dt.date(2001, 6, 1)
ORDER_COLUMNS = [
    "customer_id", "order_date", "product_id", "quantity", "status", "payment_method", "total_amount",
    "ingested_at", "order_source",
]


def first_load(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("ingested_at") <= ts_lit(CUT))


def second_load(orders: DataFrame) -> DataFrame:
    """Later orders, and the orders pending shortly before the cut sent again as completed."""
    late = orders.where(F.col("ingested_at") > ts_lit(CUT))
    pending = first_load(orders).where((F.col("status") == "pending") & (F.col("order_date") >= F.lit(RESEND_FROM)))
    again = pending.withColumns(
        {
            "status": F.lit(" completed"),
            "total_amount": F.col("total_amount") + 1.0,
            "ingested_at": F.lit("2001-08-01 12:00:00").cast("timestamp_ntz"),
        }
    )
    return late.unionByName(again)


_LATE = "_late"


def stored_loads(orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two loads, stored. The orders are made once, and written apart by load."""
    spark = orders.sparkSession
    path = scratch.new_dir(spark, "orders-loads")
    moment = F.col("ingested_at")
    orders.where(moment.isNotNull()).withColumn(_LATE, moment > ts_lit(CUT)).write.partitionBy(_LATE).parquet(path)
    held = spark.read.schema(T.StructType([*orders.schema.fields, T.StructField(_LATE, T.BooleanType())])).parquet(path)
    first, late = (held.where(c).drop(_LATE) for c in (~F.col(_LATE), F.col(_LATE)))
    return first, scratch.durable(second_load(late.unionByName(first)), "orders-second")


class States:
    """The order versions for one folder of tables, each kind written on first use.

    Branches: ``main`` (first load, then second), ``dev`` (old orders corrected
    and deleted on the first load), ``trial`` (``main`` with ``dev`` merged in),
    ``undo`` (``main`` rolled back), ``wide`` (columns added, filled, dropped).
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.base, self.delta = stored_loads(adapters.orders(spark, folder))
        for load in (self.base, self.delta):
            require_unique(load, ["order_id"])

    @cached_property
    def versions(self) -> dict:
        """The log of changes with its branches and tags: the table, and commits by name."""
        table = VersionedTable(self.spark, scratch.new_dir(self.spark, "orders-versions"), ["order_id"])
        load = table.create(self.base, CUT)
        table.branch("dev", CUT)
        dev = table.commit(self.corrections(), DEV_AT, "dev", "correct")
        main = table.merge_rows(self.delta, NOW, ORDER_COLUMNS)
        table.tag("v1_0", NOW)
        table.branch("undo", NOW)
        table.rollback(load, MERGED_AT, "undo")
        table.branch("trial", NOW)
        table.merge("dev", "trial", MERGED_AT)
        table.branch("gone", NOW)
        table.drop("gone", MERGED_AT)
        table.branch("wide", NOW)
        added = table.add_columns("delivery_date DATE, nps_score INT", MERGED_AT, "wide")
        filled = (
            table.read("wide")
            .where(F.col("order_date") >= F.lit(DELIVERED_FROM))
            .withColumns({"delivery_date": F.date_add("order_date", 3), "nps_score": F.col("quantity") * 2})
        )
        filled = table.commit(filled, MERGED_AT, "wide", "fill")
        wider = table.add_columns(
            "quantity_big BIGINT, amount DOUBLE", MERGED_AT, "wide",
            copy_from={"quantity_big": "quantity", "amount": "total_amount"},
        )
        dropped = table.drop_column("nps_score", MERGED_AT, "wide")
        return {"table": table, "load": load, "dev": dev, "main": main, "added": added, "filled": filled, "wider": wider, "dropped": dropped}

    table, load, dev, main, added, filled, wider, dropped = (
        property(lambda self, name=name: self.versions[name])
        for name in ("table", "load", "dev", "main", "added", "filled", "wider", "dropped")
    )

    @cached_property
    def stored(self) -> keyed.Keyed:
        """The first load, bucketed by order."""
        return keyed.store(self.base, ["order_id"])

    @cached_property
    def line(self) -> timeline.Timeline:
        """The first load, then the second merged into it, as spans of time."""
        first = timeline.start(self.base, ["order_id"], CUT)
        return timeline.record(first, self.delta, NOW, ORDER_COLUMNS)

    def corrections(self) -> DataFrame:
        old = self.base.where(F.col("order_date") < F.lit(DEV_BEFORE))
        keep = not_cancelled(F.col("status"))
        return old.withColumn("_op", F.when(keep, F.lit(UPSERT)).otherwise(F.lit(DELETE))).withColumn(
            "status", F.when(F.col("status") == "pending", F.lit("refunded")).otherwise(F.col("status"))
        )


_made: dict[tuple[str, str], States] = {}


def states(spark: SparkSession, folder: str) -> States:
    """The versions for a folder, written once per application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _made:
        _made[key] = States(spark, folder)
    return _made[key]


# SQL of the same tables.
_LOADED_SILVER = (
    CTES["silver"]
    .replace("FROM live l", "FROM v_live l")
    .replace("JOIN history h", "JOIN v_history h")
    .replace("2001-08-02 00:00:00", "2001-01-01 00:00:00")
)
STATE_SQL = {
    "v_base": "SELECT * FROM b_orders WHERE ingested_at <= TIMESTAMP '2001-01-01 00:00:00'",
    "v_delta": """
SELECT * FROM b_orders WHERE ingested_at > TIMESTAMP '2001-01-01 00:00:00'
UNION ALL
SELECT * REPLACE (' completed' AS status, total_amount + 1 AS total_amount, TIMESTAMP '2001-08-01 12:00:00' AS ingested_at)
FROM v_base WHERE status = 'pending' AND order_date >= DATE '2000-11-02'""",
    "v_main": """
SELECT * FROM v_delta UNION ALL
SELECT * FROM v_base old_row WHERE NOT EXISTS (FROM v_delta new_row WHERE new_row.order_id = old_row.order_id)""",
    "v_dev": """
SELECT * REPLACE (CASE WHEN order_date < DATE '1996-01-01' AND status = 'pending' THEN 'refunded' ELSE status END AS status)
FROM v_base WHERE NOT (order_date < DATE '1996-01-01' AND status = 'cancelled')""",
    "v_trial": """
SELECT * REPLACE (CASE WHEN order_date < DATE '1996-01-01' AND status = 'pending' THEN 'refunded' ELSE status END AS status)
FROM v_main WHERE NOT (order_date < DATE '1996-01-01' AND status = 'cancelled')""",
    "v_filled": """
SELECT *, CASE WHEN order_date >= DATE '2001-06-01' THEN order_date + 3 END AS delivery_date,
  CAST(CASE WHEN order_date >= DATE '2001-06-01' THEN quantity * 2 END AS INT) AS nps_score
FROM v_main""",
    "v_live": CTES["live"].replace("b_orders", "v_base"),
    "v_history": CTES["history"].replace("live", "v_live"),
    "v_silver": _LOADED_SILVER,
}
