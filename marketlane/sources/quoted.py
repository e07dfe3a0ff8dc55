"""CSV records of files with line breaks inside quotes, read by as many tasks as the files have splits.

Spark cuts a file into splits at line breaks, and a split cannot tell whether
it begins inside quotes. The number of quotes before it can: where it is odd,
the first line goes on with a value that an earlier split began. So the quotes
of each split are counted and summed up along the file (a quote inside quotes
is doubled, which changes no parity), and each line gets the parity at its
start from its split's and the lines before it. A line that begins and ends
outside quotes is a record. Only the others are put together: they are
grouped by the split and the number of the record's first line.

Files in which each line has an even number of quotes have no such values;
their lines are records as they are, and take no part in the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlane import scratch
from marketlane.operators.joins import is_small

FILE = "_file"


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"')))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, the place of their split in it, and their order in the split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
        _quotes(F.col("value")).alias("quotes"),
    )


def has_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a line of the files has an odd number of quotes. Reads until the first such line is found."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return not lines.where(_quotes(F.col("value")) % 2 == 1).isEmpty()


def _split_figures(lines: DataFrame) -> DataFrame:
    """For each split whether it begins inside quotes, and the last record that an earlier split began."""
    counted = lines.groupBy(FILE, "split").agg(
        F.sum("quotes").alias("all_quotes"),
        F.count_if(F.col("before") % 2 == 0).alias("if_outside"),
        F.count_if(F.col("before") % 2 == 1).alias("if_inside"),
    )
    earlier = Window.partitionBy(FILE).orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("all_quotes").over(earlier), F.lit(0)) % 2
    begun = F.when(F.col("inside") == 0, F.col("if_outside")).otherwise(F.col("if_inside"))
    last = F.last(F.when(F.col("begun") > 0, F.struct(F.col("split"), F.col("begun").alias("number"))), ignorenulls=True)
    figures = counted.withColumn("inside", inside).withColumn("begun", begun).withColumn("open", last.over(earlier))
    return figures.select(FILE, "split", "inside", "open")


def records(spark: SparkSession, path: str) -> DataFrame:
    """``_file``, ``record`` (its text) and ``header`` (whether it is its file's first) for each record that is not blank."""
    lines = _lines(spark, path)
    about = lines.groupBy(FILE).agg(
        F.min(F.struct("split", "at")).alias("first"), F.bool_or(F.col("quotes") % 2 == 1).alias("broken")
    )
    about = scratch.durable(about, "csv-files")
    about = F.broadcast(about) if is_small(about) else about
    known = lines.join(about, FILE).withColumn("header", F.struct("split", "at") == F.col("first")).drop("first")
    whole = known.where(~F.col("broken")).select(FILE, F.col("line").alias("record"), "header")

    upto = Window.partitionBy(FILE, "split").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    sought = known.where("broken").withColumn("before", F.coalesce(F.sum("quotes").over(upto), F.lit(0)))
    placed = sought.join(_split_figures(sought), [FILE, "split"]).withColumn("starts", (F.col("inside") + F.col("before")) % 2 == 0)
    number = F.count_if("starts").over(upto.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    own = F.when(number > 0, F.struct(F.col("split"), number.alias("number"))).otherwise(F.col("open"))
    numbered = placed.withColumn("own", own)
    alone = F.col("starts") & (F.col("quotes") % 2 == 0)
    single = numbered.where(alone).select(FILE, F.col("line").alias("record"), "header")
    parts = F.sort_array(F.collect_list(F.struct("split", "at", "line")))
    put_together = numbered.where(~alone).groupBy(FILE, "own").agg(
        F.array_join(F.transform(parts, lambda p: p["line"]), "\n").alias("record"), F.bool_or("header").alias("header")
    )
    every = whole.unionByName(single).unionByName(put_together.select(FILE, "record", "header"))
    every = every.withColumn("record", F.regexp_replace("record", "\r$", ""))
    return every.where(F.trim("record") != "")


def read(spark: SparkSession, path: str, schema: T.StructType, options: dict[str, str], malformed: str | None = None) -> DataFrame:
    """The records parsed, with ``_file``. A header that does not name the schema's columns is an error.

    With ``malformed`` a column of that name holds the text of each record that does not fit.
    """
    held = records(spark, path)
    named = T.StructType([T.StructField(f"c{k}", T.StringType()) for k in range(len(schema))])
    options = {k: v for k, v in options.items() if k != "header"}
    heads = held.where("header").select("record", F.from_csv("record", named.simpleString()[7:-1].replace(":", " "), options).alias("head"))
    sensitive = spark.conf.get("spark.sql.caseSensitive") == "true"
    shown = (lambda c: c) if sensitive else F.lower
    wrong = F.lit(False)
    for k, f in enumerate(schema):
        wrong = wrong | ~shown(F.trim(F.col(f"head.c{k}"))).eqNullSafe(shown(F.lit(f.name)))
    if bad := heads.where(wrong).select("record").head(1):
        raise ValueError(f"header {bad[0][0]!r} does not name the columns {', '.join(schema.names)}")
    fields = schema
    if malformed is not None:
        fields = T.StructType([*schema, T.StructField(malformed, T.StringType())])
        options = {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": malformed}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    parsed = held.where(~F.col("header")).select(F.from_csv("record", ddl, options).alias("row"), FILE)
    return parsed.select("row.*", FILE)
