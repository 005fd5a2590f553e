"""Records across line breaks: the boundary finder against Spark's one-task multi-line reader."""
import csv
import io
import os
import random

import pytest

from edustar.sources import files
from edustar.sources.records import CutRecordError

PIECES = ["a", "b c", "", "x,y", 'say ""hi""', "p\nq", "\n", "two\n\nlines", "end\r\nhere", "é", 'a ""', "NA", "12"]


def _file(path, rng, n, eol="\n"):
    with open(path, "w", newline="", encoding="utf-8") as out:
        out.write(f"id,A,B{eol}")
        for i in range(n):
            cells = [f'"{p}"' if rng.random() < 0.3 or any(c in p for c in '",\n\r') else p for p in rng.choices(PIECES, k=2)]
            out.write(f"{i},{cells[0]},{cells[1]}{eol}")


def python_rows(path):
    return [tuple(c or None for c in r) for r in list(csv.reader(io.StringIO(open(path, newline="").read(), newline="")))[1:]]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("seed,eol", [(1, "\n"), (2, "\r\n"), (3, "\n")])
def test_equal_to_the_one_task_reader_whatever_the_splits(spark, tmp_dir, seed, eol):
    rng = random.Random(seed)
    for k in range(2):
        _file(os.path.join(tmp_dir, f"f{k}.csv"), rng, 60, eol)
    want = [r for k in range(2) for r in python_rows(os.path.join(tmp_dir, f"f{k}.csv"))]
    want.sort(key=str)
    if eol == "\n":  # with CR LF ends, Spark's own reader also turns a CR LF inside quotes into LF
        assert rows(files.read_csv(spark, tmp_dir, "UTF-8", multi_line=True)) == want
    for size in (150, 700, 1 << 20):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", 1)
        try:
            got = files.read_csv(spark, tmp_dir, "UTF-8")
            assert rows(got) == want
            if size == 700:
                lines = spark.read.option("lineSep", "\n").text(tmp_dir)
                assert lines.rdd.getNumPartitions() > 3
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_quotes_inside_plain_fields_are_signs(spark, tmp_dir):
    path = os.path.join(tmp_dir, "f.csv")
    open(path, "w").write('A,B\n5" pipe,x\nb,6"\n"q\n,r",z\n')
    assert rows(files.read_csv(spark, path, "UTF-8")) == [('5" pipe', "x"), ("b", '6"'), ("q\n,r", "z")]


@pytest.mark.parametrize("size", [16, 1 << 20])
def test_a_cut_record_names_its_file_and_line(spark, tmp_dir, size):
    path = os.path.join(tmp_dir, "cut.csv")
    open(path, "w").write('A,B\n1,"x\ny"\n2,z\n3,"never closed\nmore\n')
    spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    try:
        with pytest.raises(CutRecordError, match=r"line 5 of .*cut\.csv"):
            files.read_csv(spark, path, "UTF-8")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("body", ['1,"a\nb"\n2\n', '1,"a\nb"\n2,x,y\n'])
def test_short_and_long_records_abort_beside_records_across_lines(spark, tmp_dir, body):
    path = os.path.join(tmp_dir, "bad.csv")
    open(path, "w").write("A,B\n" + body)
    with pytest.raises(Exception, match="MALFORMED"):
        files.read_csv(spark, path, "UTF-8").collect()


def test_header_across_lines_and_latin1(spark, tmp_dir):
    path = os.path.join(tmp_dir, "h.csv")
    open(path, "wb").write('"A\nname",B\n"é\nè",ü\nx,y\n'.encode("latin-1"))
    got = files.read_csv(spark, path, "ISO-8859-1")
    assert got.columns == ["A\nname", "B"]
    assert rows(got) == [("x", "y"), ("é\nè", "ü")]


def test_clean_files_keep_sparks_own_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "c.csv")
    open(path, "w").write('A,B\n"1",x\n2,"a ""b"""\n')
    got = files.read_csv(spark, path, "UTF-8")
    assert "FileScan csv" in got._jdf.queryExecution().toString()
    assert rows(got) == [("1", "x"), ("2", 'a "b"')]
    empty = os.path.join(tmp_dir, "e.csv")
    open(empty, "w").write("A,B\n")
    assert files.read_csv(spark, empty, "UTF-8").collect() == []
