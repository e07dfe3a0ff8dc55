"""Upserts, schema changes, versions and maintenance (groups J, K, L, M, the versioned scans of A, and Q)."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlane import schemas, scratch
from marketlane.functions.columns import ts_lit
from marketlane.operators import evolve, inspect, keyed, maintain, quality, timeline, upsert, versioned
from marketlane.plans import silver
from marketlane.registry.base import AS_OF, CUT, NOW, query
from marketlane.registry.reference_sql import CTES, msum, sql
from marketlane.registry.states import MERGED_AT, ORDER_COLUMNS, STATE_SQL, first_load, states
from marketlane.sources import adapters
from marketlane.streaming import continuous, keyfeed


def vsql(body: str, **extra: str) -> str:
    return sql(body, **STATE_SQL, **extra)


# ------------------------------------------------------------- A4 - A7


@query("a4_read_at_snapshot", vsql("SELECT * FROM v_base"))
def a4(spark, d):
    return timeline.as_of(states(spark, d).line, 1)


@query("a5_read_at_time", vsql("SELECT * FROM v_base"))
def a5(spark, d):
    return timeline.as_of(states(spark, d).line, CUT.replace(month=6))


SNAPSHOT_SQL = """
SELECT commit_no, operation, committed_at, changed_rows FROM (VALUES
  (1, 'load', TIMESTAMP '2001-01-01 00:00:00', (SELECT count(*) FROM v_base)),
  (2, 'merge', TIMESTAMP '2001-08-02 00:00:00', (SELECT count(*) FROM v_delta)))
  listed(commit_no, operation, committed_at, changed_rows)"""


@query("a6_snapshot_list", vsql(SNAPSHOT_SQL))
def a6(spark, d):
    s = states(spark, d)
    number = F.when(F.col("commit_id") == s.load, 1).otherwise(2)
    return (
        s.table.snapshots(limit=20)
        .where(F.col("commit_id").isin(s.load, s.main))
        .select(number.alias("commit_no"), "operation", "committed_at", "changed_rows")
    )


@query(
    "a7_history",
    vsql("""
SELECT * FROM (VALUES
  (TIMESTAMP '2001-08-02 00:00:00', 'merge', FALSE, (SELECT count(*) FROM v_delta)),
  (TIMESTAMP '2001-08-03 00:00:00', 'load', TRUE, (SELECT count(*) FROM v_base)))
  moved(made_current_at, operation, is_current_ancestor, changed_rows)"""),
)
def a7(spark, d):
    table = states(spark, d).table
    changed = table.snapshots().select("commit_id", "changed_rows")
    return (
        table.history("undo")
        .join(changed, "commit_id")
        .select("made_current_at", "operation", "is_current_ancestor", "changed_rows")
    )


# ------------------------------------------------------------------- J


@query(
    "j1_upsert_orders",
    vsql("""
SELECT b.* REPLACE (coalesce(n.status, b.status) AS status, coalesce(n.total_amount, b.total_amount) AS total_amount)
FROM v_base b LEFT JOIN v_delta n ON b.order_id = n.order_id
UNION ALL
SELECT n.* FROM v_delta n LEFT JOIN v_base b ON b.order_id = n.order_id WHERE b.order_id IS NULL"""),
)
def j1(spark, d):
    s = states(spark, d)
    return keyed.merge(s.stored, s.delta, ["status", "total_amount"])


# Customers without a state come late, and the premium ones move house.
_LATE = "TIMESTAMP '2001-07-01 00:00:00'"
CUSTOMER_SQL = {
    "k_first": "SELECT * FROM b_customers WHERE state IS NOT NULL",
    "k_late": f"""
SELECT * REPLACE ('Moved' || city AS city, {_LATE} AS ingested_at) FROM b_customers
WHERE state IS NULL OR customer_segment = 'Premium'""",
    "k_profiles": CTES["profiles"].replace("b_customers", "k_first").replace("TIMESTAMP '2001-08-02 00:00:00'", "TIMESTAMP '2001-01-01 00:00:00'"),
    "k_source": """
SELECT customer_id, trim(first_name) || ' ' || trim(last_name) AS customer_name, lower(trim(email)) AS customer_email,
  customer_segment, city AS customer_city, state AS customer_state, registration_date, TRUE AS is_active,
  TIMESTAMP '2001-08-02 00:00:00' AS updated_at
FROM k_late WHERE ingested_at > (SELECT max(updated_at) FROM k_profiles)""",
}
PROFILE_MERGE_SQL = vsql(
    """
SELECT p.* REPLACE (CASE WHEN n.customer_id IS NULL THEN p.customer_name ELSE n.customer_name END AS customer_name,
  CASE WHEN n.customer_id IS NULL THEN p.customer_email ELSE n.customer_email END AS customer_email,
  CASE WHEN n.customer_id IS NULL THEN p.customer_segment ELSE n.customer_segment END AS customer_segment,
  CASE WHEN n.customer_id IS NULL THEN p.customer_city ELSE n.customer_city END AS customer_city,
  CASE WHEN n.customer_id IS NULL THEN p.customer_state ELSE n.customer_state END AS customer_state,
  coalesce(n.is_active, p.is_active) AS is_active, coalesce(n.updated_at, p.updated_at) AS updated_at)
FROM k_profiles p LEFT JOIN k_source n ON p.customer_id = n.customer_id
UNION ALL BY NAME
SELECT n.* FROM k_source n LEFT JOIN k_profiles p ON p.customer_id = n.customer_id WHERE p.customer_id IS NULL""",
    **CUSTOMER_SQL,
)
PROFILE_UPDATES = [
    "customer_name", "customer_email", "customer_segment", "customer_city", "customer_state", "is_active", "updated_at",
]
PROFILE_INSERTS = ["customer_id", "registration_date", *PROFILE_UPDATES]


def customer_loads(spark, d):
    everyone = adapters.customers(spark, d)
    late = everyone.where(F.col("state").isNull() | (F.col("customer_segment") == "Premium"))
    moved = late.withColumns(
        {
            "city": F.concat(F.lit("Moved"), F.col("city")),
            "ingested_at": F.lit("2001-07-01 00:00:00").cast("timestamp_ntz"),
        }
    )
    return everyone.where(F.col("state").isNotNull()), moved


def merged_profiles(spark, d):
    first, late = customer_loads(spark, d)
    profiles = keyed.store(silver.customer_profiles(first, adapters.orders(spark, d), AS_OF, CUT), ["customer_id"])
    bronze = first.unionByName(late)
    since = upsert.high_water_mark(profiles.rows, "updated_at")
    source = scratch.durable(silver.changed_customers(bronze, since, NOW), "profile-source")
    return keyed.merge(profiles, source, PROFILE_UPDATES, PROFILE_INSERTS)


@query("j2_merge_insert_columns", PROFILE_MERGE_SQL)
def j2(spark, d):
    return merged_profiles(spark, d)


@query(
    "j3_high_water_mark",
    vsql("""
SELECT * FROM b_orders WHERE ingested_at > (SELECT max(ingested_at) FROM v_base)"""),
)
def j3(spark, d):
    mark = upsert.high_water_mark(states(spark, d).base, "ingested_at")
    return adapters.orders(spark, d).where(F.col("ingested_at") > mark)


@query(
    "j4_duplicate_key_guard",
    vsql("""
SELECT order_id, count(*) AS copies FROM (SELECT order_id FROM v_base UNION ALL SELECT order_id FROM v_delta) arrived
GROUP BY order_id HAVING count(*) > 1"""),
)
def j4(spark, d):
    s = states(spark, d)
    return quality.duplicate_keys(s.base.unionByName(s.delta), ["order_id"])


@query(
    "o3_incremental_silver_merge",
    vsql(
        """
SELECT t.* REPLACE (coalesce(n.status, t.status) AS status, coalesce(n.total_amount, t.total_amount) AS total_amount,
  coalesce(n.discount_amount, t.discount_amount) AS discount_amount,
  coalesce(n.channel_category, t.channel_category) AS channel_category,
  coalesce(n.processed_at, t.processed_at) AS processed_at)
FROM v_silver t LEFT JOIN n_silver n ON t.order_id = n.order_id
UNION ALL
SELECT n.* FROM n_silver n LEFT JOIN v_silver t ON t.order_id = n.order_id WHERE t.order_id IS NULL""",
        n_live=CTES["live"].replace("b_orders", "v_delta"),
        n_history="SELECT NULL AS customer_id, NULL AS first_day, NULL AS n_orders WHERE FALSE",
        n_raw=CTES["silver"].replace("FROM live l", "FROM n_live l").replace("JOIN history h", "JOIN n_history h"),
        n_silver="""
SELECT * REPLACE (FALSE AS is_first_order, FALSE AS is_repeat_customer, 'New' AS customer_value_tier,
  CAST(1 AS BIGINT) AS customer_lifetime_orders) FROM n_raw""",
    ),
)
def o3(spark, d):
    s = states(spark, d)
    customers, products = adapters.customers(spark, d), adapters.products(spark, d)
    target = keyed.store(silver.enrich_orders(s.base, customers, products, CUT), ["order_id"])
    bronze = s.base.unionByName(s.delta)
    since = upsert.high_water_mark(target.rows, "processed_at")
    source = scratch.durable(silver.arrivals(bronze, customers, products, since, NOW), "silver-arrivals")
    return keyed.merge(target, source, ["status", "total_amount", "discount_amount", "channel_category", "processed_at"])


@query("o4_profile_merge", PROFILE_MERGE_SQL)
def o4(spark, d):
    return merged_profiles(spark, d)


# ------------------------------------------------------------------- K


def _grown(spark, d):
    """The current orders in files of two widths: those of the first load as they were, later ones with two more columns."""
    held = states(spark, d)
    current = timeline.as_of(held.line, NOW).select("order_id", *ORDER_COLUMNS)
    early = F.coalesce(F.col("ingested_at") <= ts_lit(CUT), F.lit(True))
    table = evolve.store(current.where(early), "growing")
    wide = evolve.add_columns(table, {"delivery_date": "date", "nps_score": "int"})
    evolve.append(wide, current.where(~early))
    return wide


@query(
    "k1_add_columns",
    vsql("SELECT *, CAST(NULL AS DATE) AS delivery_date, CAST(NULL AS INT) AS nps_score FROM v_main"),
)
def k1(spark, d):
    return _grown(spark, d).rows


@query(
    "k2_drop_column",
    vsql("""SELECT * EXCLUDE (nps_score), CAST(quantity AS BIGINT) AS quantity_big, total_amount AS amount FROM v_filled"""),
)
def k2(spark, d):
    return states(spark, d).table.read("wide")


@query("k2_dropped_column_time_travel", vsql("SELECT * FROM v_filled"))
def k2_before(spark, d):
    s = states(spark, d)
    return s.table.read(commit_id=s.filled)


@query(
    "k3_upcast_and_rename",
    vsql("SELECT order_id, CAST(quantity AS BIGINT) AS quantity_big, total_amount AS amount FROM v_filled"),
)
def k3(spark, d):
    s = states(spark, d)
    return s.table.read(commit_id=s.wider).select("order_id", "quantity_big", "amount")


_WIDE = """order_id string, customer_id string, order_date date, product_id string, quantity int, status string,
payment_method string, total_amount double, ingested_at timestamp_ntz, order_source string, delivery_date date, quantity_big bigint, amount double"""


@query(
    "k4_describe",
    "SELECT * FROM (VALUES "
    + ", ".join(f"({i}, '{c.split()[0]}', '{c.split()[1]}')" for i, c in enumerate(_WIDE.split(",")))
    + ") AS t(position, col_name, data_type)",
)
def k4(spark, d):
    return inspect.describe(spark, states(spark, d).table.read("wide"))


@query("k5_old_projection", vsql("SELECT order_id, total_amount FROM v_main"))
def k5(spark, d):
    return _grown(spark, d).rows.select("order_id", "total_amount")


# ------------------------------------------------------------------- L


@query("l1_commit", vsql("SELECT * FROM v_main"))
def l1(spark, d):
    return states(spark, d).table.read()


@query("l2_snapshots", vsql(SNAPSHOT_SQL))
def l2(spark, d):
    s = states(spark, d)
    number = F.when(F.col("commit_id") == s.load, 1).otherwise(2)
    listed = s.table.snapshots().where(F.col("commit_id").isin(s.load, s.main))
    return listed.select(number.alias("commit_no"), "operation", "committed_at", "changed_rows")


@query("l3_state_as_of", vsql("SELECT order_id, status, total_amount FROM v_main"))
def l3(spark, d):
    return timeline.as_of(states(spark, d).line, NOW).select("order_id", "status", "total_amount")


COMPARE_SQL = vsql(f"""
SELECT 'avant_merge' AS version, count(*) AS total_orders, {msum('total_amount')} AS total_revenue FROM v_base
UNION ALL
SELECT 'apres_merge', count(*), {msum('total_amount')} FROM v_main""")


def version_report(spark, d):
    moments = {"avant_merge": CUT, "apres_merge": NOW}
    return timeline.compare(states(spark, d).line, moments, "total_amount", "total_orders", "total_revenue")


@query("l4_compare_states", COMPARE_SQL)
def l4(spark, d):
    return version_report(spark, d)


@query("o23_version_comparison", COMPARE_SQL)
def o23(spark, d):
    return version_report(spark, d)


@query("l5_rollback", vsql("SELECT * FROM v_base"))
def l5(spark, d):
    return states(spark, d).table.read("undo")


@query("l6_branch", vsql("SELECT * FROM v_dev"))
def l6(spark, d):
    return states(spark, d).table.read("dev")


@query("l7_merge_branch", vsql("SELECT * FROM v_trial"))
def l7(spark, d):
    return states(spark, d).table.read("trial")


@query(
    "l8_branches_and_tags",
    vsql("""
SELECT * FROM (VALUES ('main', 'branch', (SELECT count(*) FROM v_main)), ('dev', 'branch', (SELECT count(*) FROM v_dev)),
  ('undo', 'branch', (SELECT count(*) FROM v_base)), ('trial', 'branch', (SELECT count(*) FROM v_trial)),
  ('wide', 'branch', (SELECT count(*) FROM v_filled)), ('v1_0', 'tag', (SELECT count(*) FROM v_main)))
  listed(name, kind, row_count)"""),
)
def l8(spark, d):
    table = states(spark, d).table
    counted = quality.layer_counts({n: table.read(n) for n in ("main", "dev", "undo", "trial", "wide", "v1_0")})
    return table.refs().join(counted.withColumnRenamed("layer", "name"), "name").select("name", "kind", "row_count")


# ------------------------------------------------------------------- M


@query("m1_compaction", sql("SELECT * FROM b_orders"))
def m1(spark, d):
    scattered = scratch.new_dir(spark, "scattered")
    adapters.orders(spark, d).repartition(64).write.parquet(scattered)
    return maintain.compact(spark, scattered, scratch.new_dir(spark, "compacted"))


@query(
    "m1_compaction_files",
    """SELECT 'scattered' AS layout, count(*) AS record_count, FALSE AS few_files FROM orders
UNION ALL SELECT 'compacted', count(*), TRUE FROM orders""",
)
def m1_files(spark, d):
    scattered = scratch.new_dir(spark, "scattered")
    adapters.orders(spark, d).repartition(64).write.parquet(scattered)
    packed = maintain.compact(spark, scattered, scratch.new_dir(spark, "compacted"))
    before = inspect.files(spark.read.parquet(scattered)).agg(F.count(F.lit(1)).alias("files"), F.sum("record_count").alias("record_count"))
    after = inspect.files(packed).agg(F.count(F.lit(1)).alias("files"), F.sum("record_count").alias("record_count"))
    both = before.withColumn("layout", F.lit("scattered")).unionByName(after.withColumn("layout", F.lit("compacted")))
    return both.select("layout", "record_count", (F.col("files") < 8).alias("few_files"))


@query("m2_sorted_rewrite", sql("SELECT * FROM job_orders"))
def m2(spark, d):
    from marketlane.registry.products import job_orders

    stored = scratch.durable(job_orders(spark, d), "job-orders")
    out = scratch.new_dir(spark, "sorted")
    return maintain.sorted_rewrite(stored, out, ["order_year", "order_month", "customer_id"], "order_id")


_CURVE = ["order_year", "order_month", "customer_id"]


def _along_curve(spark, d):
    from marketlane.registry.products import job_orders

    stored = scratch.durable(job_orders(spark, d), "job-orders")
    return maintain.curve_rewrite(stored, scratch.new_dir(spark, "curve"), _CURVE, "order_id", 64)


@query("m2_curve_rewrite", sql("SELECT * FROM job_orders"))
def m2_curve(spark, d):
    return _along_curve(spark, d)


@query(
    "m2_curve_files",
    sql("""SELECT order_year, order_month, count(*) AS orders, count(customer_id) AS with_customer, TRUE AS few_files
FROM job_orders GROUP BY order_year, order_month"""),
)
def m2_curve_files(spark, d):
    """Orders of each month, and whether less than half of the files can hold the month."""
    laid = _along_curve(spark, d)
    months = laid.groupBy("order_year", "order_month").agg(
        F.count(F.lit(1)).alias("orders"), F.count("customer_id").alias("with_customer")
    )
    spans = scratch.durable(inspect.ranges(laid, _CURVE), "ranges")
    # A file's months lie in a box of years and months: as many rows as the calendar has in it.
    year = F.explode(F.sequence("min_order_year", "max_order_year")).alias("order_year")
    month = F.explode(F.sequence("min_order_month", "max_order_month")).alias("order_month")
    may_hold = spans.select("file_path", "min_order_month", "max_order_month", year).select("order_year", month)
    files = may_hold.groupBy("order_year", "order_month").agg(F.count(F.lit(1)).alias("files"))
    every = spans.count()
    return months.join(files, ["order_year", "order_month"], "left").select(
        "order_year", "order_month", "orders", "with_customer", (F.col("files") * 2 < every).alias("few_files")
    )


@query("m3_snapshot_expiry", vsql("SELECT * FROM v_main"))
def m3(spark, d):
    """A table of its own: the first load expires, the current state must not change."""
    s = states(spark, d)
    table = versioned.VersionedTable(spark, scratch.new_dir(spark, "expiring"), ["order_id"])
    table.create(s.base, CUT)
    table.merge_rows(s.delta, NOW, ORDER_COLUMNS)
    table.expire(older_than=NOW)
    table.sweep()
    return table.read()


# ------------------------------------------------------------------- Q


def _late_and_new(spark, s):
    """The second load as a stream of files; an older version of every arriving row comes last and must not win."""
    inbox = scratch.new_dir(spark, "inbox")
    s.delta.repartitionByRange(2, "ingested_at").write.parquet(inbox)
    older = s.delta.withColumn("ingested_at", F.col("ingested_at") - F.expr("INTERVAL 2000 DAYS"))
    older.withColumn("status", F.lit("outdated")).coalesce(1).write.mode("append").parquet(inbox)
    return continuous.arriving_files(spark, inbox, schemas.BRONZE_ORDERS, files_per_batch=1)


@query("q1_streaming_upsert", vsql("SELECT * FROM v_main"))
def q1(spark, d):
    s = states(spark, d)
    table = versioned.VersionedTable(spark, scratch.new_dir(spark, "streamed"), ["order_id"])
    table.create(s.base, CUT)
    stream = _late_and_new(spark, s)
    continuous.upsert_stream(
        stream, table, ORDER_COLUMNS, scratch.new_dir(spark, "stream-state"), "ingested_at"
    ).awaitTermination()
    return table.read()


@query("q1_stateful_upsert", vsql("SELECT * FROM v_main"))
def q1_stateful(spark, d):
    s = states(spark, d)
    feed = keyfeed.start(s.base, ["order_id"], "ingested_at")
    stream = _late_and_new(spark, s)
    keyfeed.listen(feed, stream, scratch.new_dir(spark, "feed-state")).awaitTermination()
    return keyfeed.current(feed)
