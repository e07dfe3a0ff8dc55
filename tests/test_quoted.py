"""CSV files with line breaks in quotes, cut into many splits, against Python's reader."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from marketlane.sources import files, quoted

SCHEMA = "id INT, note STRING, v DOUBLE"


@pytest.fixture(scope="module")
def folder_of_files(tmp_path_factory):
    """Files whose values hold line breaks, quotes and commas, one without any, and one of one value over many splits."""
    rng = random.Random(8)
    folder = tmp_path_factory.mktemp("csv")
    pieces = ["plain", '"', '""', "\n", "\n\n", ",", " a ", '",\n"', "x" * 300, "é"]
    for name in ("one.csv", "two words.csv"):
        with open(folder / name, "w", newline="", encoding="utf-8") as out:
            writer = csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_MINIMAL)
            writer.writerow(["id", "note", "v"])
            for k in range(400):
                writer.writerow([k, "n" + "".join(rng.choices(pieces, k=rng.randint(0, 6))) + "e", k / 4])
    (folder / "plain.csv").write_text("id,note,v\n" + "".join(f"{k},row {k},{k}.5\n" for k in range(300)) + "\n\n")
    (folder / "long.csv").write_text('id,note,v\n1,"' + "line\n" * 4000 + 'end",2.5\n2,after,3.5\n')
    return folder


def expected(folder):
    out = []
    for path in folder.glob("*.csv"):
        with open(path, newline="", encoding="utf-8") as f:
            out += [(path.name, int(r["id"]), r["note"], float(r["v"])) for r in csv.DictReader(f)]
    return sorted(out)


@pytest.mark.parametrize("split", ["1k", "7k", "128m"])
def test_equals_the_plain_reader(spark, folder_of_files, rows, split):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = files.read_csv(spark, str(folder_of_files), SCHEMA, origin="file")
        assert rows(got, "file", "id", "note", "v") == expected(folder_of_files)
        tasks = quoted._lines(spark, str(folder_of_files)).rdd.getNumPartitions()
        assert tasks > 20 or split != "1k"
        assert quoted.has_line_breaks(spark, str(folder_of_files)) and not quoted.has_line_breaks(spark, str(folder_of_files / "plain.csv"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_whole_lines_are_not_grouped(spark, folder_of_files):
    """Of a file without line breaks in values no line goes through the window or the grouping."""
    plan = quoted.records(spark, str(folder_of_files / "plain.csv"))
    assert plan.count() == 301 and plan.where("header").count() == 1


def test_windows_line_ends_and_bad_records(spark, tmp_path, rows):
    path = tmp_path / "in.csv"
    path.write_bytes(b'id,note,v\r\n1,"a\nb",1.5\r\nbad,"c,\n""d""",2.5\r\n3,e,x\r\n4,,\r\n')
    got = rows(files.read_csv(spark, str(path), SCHEMA, malformed=True))
    assert [r[:3] for r in got if r[3] is None] == [(1, "a\nb", 1.5), (4, None, None)][::1]
    assert sorted(r[3] for r in got if r[3]) == ["3,e,x", 'bad,"c,\n""d""",2.5']


def test_wrong_header_is_refused(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,remark,v\n1,"a\nb",1.5\n')
    with pytest.raises(ValueError):
        files.read_csv(spark, str(path), SCHEMA)


def test_inferred_types(spark, folder_of_files):
    assert dict(files.read_csv(spark, str(folder_of_files)).dtypes) == {"id": "int", "note": "string", "v": "double"}
    assert files.read_csv(spark, str(folder_of_files)).where(F.col("note").contains("\n")).count() > 100
