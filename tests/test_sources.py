import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from marketlane import schemas, scratch
from marketlane.operators import inspect, maintain, versioned
from marketlane.plans import daily_run
from marketlane.registry.base import AS_OF, NOW
from marketlane.registry.states import ORDER_COLUMNS, first_load, second_load
from marketlane.sources import adapters, files, tables
from marketlane.streaming import continuous


def test_csv_keeps_padding_and_nulls(spark, rows):
    df = spark.createDataFrame([(" a ", None), (None, 'x,"y"'), ("line\nbreak", "z")], "p STRING, q STRING")
    path = scratch.new_dir(spark, "csv")
    files.write_csv(df.where("p IS NULL OR p NOT LIKE '%break%'"), path)
    assert rows(files.read_csv(spark, path, "p STRING, q STRING")) == [(None, 'x,"y"'), (" a ", None)]


def test_inference_finds_the_types(spark, folder):
    path = scratch.new_dir(spark, "csv")
    files.write_csv(adapters.products(spark, folder).drop("ingested_at"), path)
    assert dict(files.read_csv(spark, path).dtypes) == {
        "product_id": "string", "product_name": "string", "category": "string", "price": "double", "stock_quantity": "int",
    }


def test_ingest_stamps_and_tolerates_bad_dates(spark):
    path = scratch.new_dir(spark, "csv")
    files.write_csv(spark.createDataFrame([("a", "2024-01-05"), ("b", "soon")], "id STRING, day STRING"), path)
    got = files.ingest(spark, path, scratch.new_dir(spark, "bronze"), "id STRING, day STRING", ("day",), NOW)
    found = {r["id"]: r for r in got.collect()}
    assert found["a"]["day"] == dt.date(2024, 1, 5) and found["b"]["day"] is None
    assert found["a"]["ingested_at"] == NOW and found["a"]["data_quality_flag"] == "pending"
    assert found["a"]["source_file"].endswith(".csv")


def test_long_keys_are_not_cut(spark):
    from marketlane.sources.adapters import _padded

    df = spark.createDataFrame([(7,), (123456789012,)], "k BIGINT")
    assert [r[0] for r in df.selectExpr(_padded("k", "ORD-", 8)).collect()] == ["ORD-00000007", "ORD-123456789012"]


def test_month_filter_reads_only_that_partition(spark, folder):
    path = scratch.new_dir(spark, "by-month")
    orders = adapters.orders(spark, folder).withColumn("order_month", F.month("order_date"))
    files.write_parquet(orders, path, ("order_month",))
    plan = files.read_parquet(spark, path).where("order_month = 7")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan


def test_hot_partition_is_written_in_several_files(spark):
    path = scratch.new_dir(spark, "hot")
    df = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") % 20).otherwise(99).alias("p"), F.sha2(F.col("id").cast("string"), 256).alias("x")
    )
    small = scratch.new_dir(spark, "small")
    df.repartition(8).write.parquet(small)
    packed = maintain.compact(spark, small, path, ("p",), target_bytes=1_000_000)
    stats = {r["p"]: r for r in inspect.partition_stats(packed, ["p"]).collect()}
    assert sum(r["record_count"] for r in stats.values()) == 200_000
    assert stats[99]["file_count"] > 2 and stats[0]["file_count"] <= 2


def test_sorted_rewrite_orders_within_and_across_files(spark, folder):
    orders = scratch.durable(adapters.orders(spark, folder).withColumn("y", F.year("order_date")), "o")
    done = maintain.sorted_rewrite(orders, scratch.new_dir(spark, "sorted"), ["y", "customer_id"], "order_id", partitions=4)
    spans = (
        done.groupBy(F.col("_metadata.file_name").alias("f"))
        .agg(F.min("y").alias("low"), F.max("y").alias("high"), F.count(F.lit(1)).alias("n"))
        .orderBy("f")
        .collect()
    )
    assert len(spans) == 4 and sum(r["n"] for r in spans) == orders.count()
    assert all(a["high"] <= b["low"] for a, b in zip(spans, spans[1:]))


@pytest.fixture()
def namespace(spark):
    name = f"ns_{uuid.uuid4().hex[:10]}"
    assert tables.create_namespaces(spark, scratch.new_dir(spark, "wh"), [name, "not a name"]) == ["not a name"]
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_create_as_select_does_nothing_twice(spark, namespace, rows):
    df = spark.createDataFrame([(1, "a")], "i INT, p STRING")
    assert tables.create_as_select(df, f"{namespace}.t", ("p",))
    assert not tables.create_as_select(df.union(df), f"{namespace}.t")
    assert rows(tables.scan(spark, f"{namespace}.t")) == [(1, "a")]


def test_insert_goes_by_name_and_overwrite_is_repeatable(spark, namespace, rows):
    tables.create_table(spark, f"{namespace}.t", "i INT, v STRING, p STRING", ("p",))
    df = spark.createDataFrame([("x", "v1", 1), ("y", "v2", 2)], "p STRING, v STRING, i INT")
    tables.insert(df, f"{namespace}.t")
    tables.insert_overwrite(df.where("p = 'x'"), f"{namespace}.t")
    tables.insert_overwrite(df.where("p = 'x'"), f"{namespace}.t")
    assert rows(tables.scan(spark, f"{namespace}.t")) == [(1, "v1", "x"), (2, "v2", "y")]


def test_replayed_stream_batch_and_restart_change_nothing(spark, folder, rows):
    orders = scratch.durable(adapters.orders(spark, folder), "o")
    base, late = first_load(orders), second_load(orders)
    table = versioned.VersionedTable(spark, scratch.new_dir(spark, "t"), ["order_id"])
    table.create(base, NOW)
    inbox, checkpoint = scratch.new_dir(spark, "in"), scratch.new_dir(spark, "ck")
    late.coalesce(1).write.parquet(inbox)

    def go(state):
        stream = continuous.arriving_files(spark, inbox, schemas.BRONZE_ORDERS)
        continuous.upsert_stream(stream, table, ORDER_COLUMNS, state, "ingested_at").awaitTermination()

    go(checkpoint)
    first, head = rows(table.read()), table.head()
    go(checkpoint)  # nothing new arrived
    go(scratch.new_dir(spark, "ck"))  # a lost checkpoint replays batch 0
    assert table.head() == head and rows(table.read()) == first
    again = late.where("total_amount > 0").withColumns(
        {"status": F.lit("refunded"), "ingested_at": F.col("ingested_at") + F.expr("INTERVAL 1 DAY")}
    )
    again.unionByName(late.where("total_amount > 0")).coalesce(1).write.mode("append").parquet(inbox)
    go(checkpoint)  # two versions of each key: the newer one counts
    assert table.read().where("status = 'refunded'").count() == again.count()
    assert table.read().count() == len(first)
    newest = rows(table.read())
    outdated = again.withColumns({"status": F.lit("old"), "ingested_at": F.col("ingested_at") - F.expr("INTERVAL 9 DAY")})
    outdated.coalesce(1).write.mode("append").parquet(inbox)
    go(checkpoint)  # an older version arrives last
    assert rows(table.read()) == newest
    extra = late.limit(1).withColumns({"order_id": F.lit("ORD-NEW"), "status": F.lit("new")})
    extra.coalesce(1).write.mode("append").parquet(inbox)
    go(scratch.new_dir(spark, "ck"))  # a new checkpoint after more files arrived takes in every file
    assert table.read().where("order_id = 'ORD-NEW'").count() == 1
    assert table.read().count() == len(first) + 1


def test_commit_times_rise(spark, folder):
    table = versioned.VersionedTable(spark, scratch.new_dir(spark, "t"), ["order_id"])
    base = first_load(adapters.orders(spark, folder))
    table.create(base, NOW)
    with pytest.raises(ValueError):
        table.commit(base.limit(1), NOW - dt.timedelta(days=5))


def test_whole_run_twice_gives_the_same_tables(spark, folder):
    bronze = [adapters.orders(spark, folder), adapters.customers(spark, folder), adapters.products(spark, folder)]
    out = scratch.new_dir(spark, "run")
    layout = {"bronze.orders": ()}
    once = daily_run.run(spark, *bronze, out, AS_OF, NOW, layout)
    sums = {n: df.agg(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()[0] for n, df in once.items()}
    twice = daily_run.run(spark, *bronze, out, AS_OF, NOW, layout)
    for name, df in twice.items():
        assert df.agg(F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()[0] == sums[name], name
    for name, (ddl, _) in schemas.TABLES.items():
        assert sorted(twice[name].columns) == sorted(schemas.names(ddl))


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Away:
        class sparkContext:  # noqa: N801
            master = "spark://host"

        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError):
        scratch.root(Away)


def test_csv_keeps_quotes_line_breaks_and_sets_bad_records_apart(spark, tmp_path, rows):
    source = tmp_path / "in.csv"
    source.write_text('id,name,price\nP1,"Desk, 27"" wide",10.5\nP2,"two\nlines",7.0\nP3,plain,cheap\nP4,,\n')
    schema = "id STRING, name STRING, price DOUBLE"
    read = files.read_csv(spark, str(source), schema)
    assert rows(read) == [("P1", 'Desk, 27" wide', 10.5), ("P2", "two\nlines", 7.0), ("P3", "plain", None), ("P4", None, None)]
    back = scratch.new_dir(spark, "csv")
    files.write_csv(read, back)
    assert rows(files.read_csv(spark, back, schema)) == rows(read)
    out, rejects = scratch.new_dir(spark, "out"), scratch.new_dir(spark, "rejects")
    layer = files.ingest(spark, str(source), out, schema, (), NOW, rejects)
    assert rows(layer, "id") == [("P1",), ("P2",), ("P4",)]
    assert rows(files.read_parquet(spark, rejects), "id", files.MALFORMED) == [("P3", "P3,plain,cheap")]
    with pytest.raises(Exception, match="malformed record"):
        files.ingest(spark, str(source), scratch.new_dir(spark, "out"), schema, (), NOW)


def test_sorted_files_are_as_many_as_the_rows_need(spark, monkeypatch):
    """However well the rows compress, a task sorts a bounded number of them."""
    df = scratch.durable(spark.range(20_000).select("id", F.lit(None).cast("string").alias("a"), F.lit("same").alias("b")), "flat")
    monkeypatch.setattr(maintain, "SORT_ROWS", 1000)
    done = maintain.sorted_rewrite(df, scratch.new_dir(spark, "sorted"), ["a", "b"], "id")
    sizes = [r["n"] for r in done.groupBy(F.col("_metadata.file_name")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 20_000 and max(sizes) <= 2000
