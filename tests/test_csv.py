"""Messy CSV files, written for each run."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from prepframe.operators.rowid import with_row_id
from prepframe.scratch import release_scratch, scratch_path, stored
from prepframe.sources import csv


@pytest.fixture()
def write(tmp_path):
    def _write(name: str, content: str | bytes) -> str:
        path = tmp_path / name
        path.write_bytes(content if isinstance(content, bytes) else content.encode())
        return str(path)

    return _write


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_byte_order_mark_and_blank_header(spark, write):
    path = write("bom.csv", "﻿ id ;name;price;when\n" + "".join(f"{i};n;{i},5;{i + 10}.02.2020\n" for i in range(1, 6)))
    df = csv.read_csv(spark, path)
    assert df.columns == ["id", "name", "price", "when"]
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "string", "double", "timestamp_ntz"]
    assert df.schema["name"].metadata["categories"] == ["n"]


def test_bad_lines(spark, write):
    path = write("bad.csv", "a;b;c\n1;2;3\n1;2\n1;2;3;4\n")
    df = csv.read_csv(spark, path)
    assert rows(df) == [(1, 2, 3), (1, 2, None)]
    assert df.count() == 2
    assert df.select("c").count() == df.select("a").count() == 2
    quoted = write("quoted.csv", 'a;b\n"x;y;z";"say ""hi"""\n')
    assert rows(csv.read_csv(spark, quoted)) == [("x;y;z", 'say "hi"')]


def test_missing_tokens(spark, write):
    path = write("na.csv", "a,b\nNA,1\nnull,2\nN/A,3\n,4\nnan,5\nword,6\n NA,7\n")
    assert [r[0] for r in rows(csv.read_csv(spark, path))] == [None] * 5 + ["word", " NA"]


def test_decimal_comma_and_loss(spark, write):
    path = write("comma.csv", "price;n\n" + "".join(f"{i},25;{i}\n" for i in range(9)) + "x;9\n")
    profile = {r["column"]: r for r in csv.csv_profile(spark, path).collect()}
    assert (profile["price"]["kind"], profile["price"]["decimal_mark"], profile["price"]["parse_loss"]) == ("numeric", ",", 1)
    values = [r["price"] for r in csv.read_csv(spark, path).orderBy("n").collect()]
    assert values == [i + 0.25 for i in range(9)] + [None]


def test_dates(spark, write):
    path = write("dates.csv", "d\n01.02.2020\n13.02.2020\n05.06.2020\n")
    assert csv.csv_profile(spark, path).first()["date_format"] == "d.M.yyyy"
    listed = write("listed.csv", "d,x\n01-12-2009 07:45,1\nbad,2\n")
    got = csv.read_csv(spark, listed, date_columns=["d"], date_format="d-M-yyyy H:m")
    assert [r[0] for r in got.select(F.col("d").cast("string")).collect()] == ["2009-12-01 07:45:00", None]


def test_encoding_falls_back(spark, write):
    path = write("latin.csv", b"a;b\ncaf\xe9;x\nna\xefve;y\n")
    assert csv.sniff(spark, path) == (";", "ISO-8859-1")
    assert sorted(rows(csv.read_csv(spark, path))) == [("café", "x"), ("naïve", "y")]
    assert csv.dialects(spark, path).first()["encoding"] == "ISO-8859-1"


def test_booleans_stay(spark, write):
    path = write("bool.csv", "f,i\nTrue,1\nFalse,2\nTrue,3\n")
    assert [r[0] for r in rows(csv.read_csv(spark, path))] == [True, False, True]


@pytest.mark.parametrize(
    ("text", "separator"), [("a\tb\n1\t2\n", "\t"), ("a|b\n1|2\n", "|"), ("a\n1\n", ","), ("a,b;c\n1,2;3\n", ",")]
)
def test_separators(spark, write, text, separator):
    path = write("sep.csv", text)
    assert csv.sniff(spark, path)[0] == separator
    assert csv.dialects(spark, path).first()["separator"] == separator


def test_only_the_first_five_lines_decide(spark, write):
    path = write("long.csv", "a;b\n" + "1;2\n" * 4 + "1,2,3,4,5,6,7,8,9;1\n" * 50)
    assert csv.sniff(spark, path)[0] == csv.dialects(spark, path).first()["separator"] == ";"


def test_required_columns(spark, write):
    path = write("req.csv", "a,b\n1,\n2,x\n")
    assert rows(csv.read_csv(spark, path, required=["b"])) == [(2, "x")]
    with pytest.raises(ValueError):
        csv.read_csv(spark, path, required=["c"])
    with pytest.raises(AnalysisException):
        csv.read_csv(spark, "/no/such/file.csv")


def test_lines_can_be_put_back_in_order(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    path = str(tmp_path / "big")
    spark.range(20000).select("id", F.repeat(F.lit("x"), 20).alias("pad")).coalesce(1).write.csv(path, header=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        raw = csv.read_raw(spark, path, ",", row_order=True).repartition(5)
        numbered = with_row_id(raw, csv.ROW_ORDER)
        assert numbered.where("cast(id AS long) <> _row_id").count() == 0 and numbered.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_writing(spark, m, tmp_path):
    path = str(tmp_path / "out")
    csv.write_csv(m.withColumn("_row_id", F.col("row_id")), path, single_file=True)
    assert len(list((tmp_path / "out").glob("part-*.csv"))) == 1
    back = csv.read_csv(spark, path)
    assert back.columns == m.columns
    assert sorted(rows(back), key=str) == sorted(rows(m.withColumn("t", F.col("t"))), key=str)
    with pytest.raises(AnalysisException):
        csv.write_csv(m, path)


def test_scratch_is_in_the_shared_folder(spark, m):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(shared)
    table = stored(m, "kept")
    assert table.count() == 6
    release_scratch(spark)
    assert spark.read.format("binaryFile").option("recursiveFileLookup", True).load(shared).count() == 0


def test_one_late_byte_decides_the_encoding(spark, write):
    path = write("late.csv", b"id;name\n" + b"".join(b"%d;plain\n" % i for i in range(400)) + b"400;za\xfe caf\xe9\n")
    assert csv.sniff(spark, path) == (";", "ISO-8859-1")
    assert [r["name"] for r in csv.read_csv(spark, path).where("id = 400").collect()] == ["zaþ café"]


def test_files_are_matched_by_their_headers(spark, tmp_path):
    folder = tmp_path / "some files"
    folder.mkdir()
    (folder / "1 first.csv").write_text("a;b\n1;x\n2;y\n")
    (folder / "2%20second.csv").write_text("b,a,c\nz,3,new\n")
    (folder / "3.csv").write_text("a;b\n4;w\n")
    (folder / "4 empty.csv").write_text("")
    df = csv.read_csv(spark, str(folder))
    assert df.columns == ["a", "b", "c"]
    assert sorted(rows(df)) == [(1, "x", None), (2, "y", None), (3, "z", "new"), (4, "w", None)]


def test_empty_files(spark, write):
    path = write("empty.csv", "")
    for read in (csv.read_csv, csv.csv_profile, csv.sniff):
        with pytest.raises(ValueError, match="empty.csv"):
            read(spark, path)
    assert csv.read_csv(spark, write("head.csv", "a,b\n")).count() == 0


def test_jobs_of_a_read(spark, tmp_path):
    def jobs(columns):
        path = str(tmp_path / f"c{columns}")
        spark.range(500).select(*[(F.col("id") * i).cast("string").alias(f"x{i}") for i in range(columns)]).write.csv(path, header=True)
        spark.sparkContext.setJobGroup(f"csv-{columns}", "")
        assert csv.read_csv(spark, path).count() == 500
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"csv-{columns}"))

    few = jobs(3)
    assert few <= 20 and jobs(30) <= few + 1
