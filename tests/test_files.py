"""File tests: the CSV readers in a temp folder."""

import os

import pytest

from edustar.schema import REGISTER_COLUMNS
from edustar.sources import files


def _write(path, text, encoding):
    with open(path, "wb") as fh:
        fh.write(text.encode(encoding))
    return path


REG_HEADER = ",".join(f'"{c}"' for c in REGISTER_COLUMNS) + ",Extra (col)\n"


def test_register_latin1_quotes_newline_and_tokens(spark, tmp_dir):
    body = ('100001,"École Ste-Thérèse, Nord",Primary,9,"Bärnet",Open,London,x\n'
            '100002,"Say ""hi""\nthere",Secondary,012,NA,Closed,None,y\n')
    p = _write(os.path.join(tmp_dir, "reg.csv"), REG_HEADER + body, "latin-1")
    rows = files.read_register_csv(spark, p).orderBy("urn").collect()
    assert rows == files.read_register_csv(spark, p, multi_line=True).orderBy("urn").collect()
    assert list(rows[0].asDict()) == list(REGISTER_COLUMNS.values())
    assert rows[0]["establishment_name"] == "École Ste-Thérèse, Nord"
    assert rows[0]["la_name"] == "Bärnet"
    assert rows[1]["establishment_name"] == 'Say "hi"\nthere'
    assert rows[1]["la_code"] == "012"
    assert rows[1]["la_name"] is None and rows[1]["region_name"] is None


@pytest.mark.parametrize("bom,encoding", [("﻿", "utf-8"), ("﻿", "latin-1")])
def test_register_with_bom(spark, tmp_dir, bom, encoding):
    if encoding == "latin-1":
        data = "﻿".encode("utf-8") + (REG_HEADER + "1,a,b,c,d,e,f,g\n").encode("latin-1")
        p = os.path.join(tmp_dir, "bom.csv")
        open(p, "wb").write(data)
    else:
        p = _write(os.path.join(tmp_dir, "bom.csv"), bom + REG_HEADER + "1,a,b,c,d,e,f,g\n", encoding)
    rows = files.read_register_csv(spark, p).collect()
    assert rows[0]["urn"] == "1"


def test_register_missing_column_raises_before_any_job(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "m.csv"), "URN,EstablishmentName\n1,a\n", "latin-1")
    with pytest.raises(ValueError, match="PhaseOfEducation"):
        files.read_register_csv(spark, p)


def test_short_row_aborts(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "s.csv"), "a,b,c\n1,2,3\n4,5\n", "utf-8")
    with pytest.raises(Exception):
        files.read_ees_csv(spark, p).collect()


def test_ees_headers_tokens_and_markers(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "e.csv"),
               "Time Period,Overall Absence %,School-Type\n2022,c,N/A\n2023,,low\n2024,n/a,x\n", "utf-8")
    df = files.read_ees_csv(spark, p)
    assert df.columns == ["time_period", "overall_absence", "school_type"]
    got = [tuple(r) for r in df.orderBy("time_period").collect()]
    assert got == [("2022", "c", None), ("2023", None, "low"), ("2024", None, "x")]


def test_colliding_headers_raise(spark):
    df = spark.createDataFrame([(1, 2)], "`A b` int, `a_b` int")
    with pytest.raises(ValueError, match="both become"):
        files.sanitise_headers(df)


def test_sanitise_name():
    assert files.sanitise_name("  LA (code) ") == "la_code"
    assert files.sanitise_name("ï»¿URN") == "urn"
    assert files.sanitise_name("GOR (name)") == "gor_name"


def test_land_twice_is_the_same_table(spark, tmp_dir):
    df = spark.createDataFrame([("1", "a"), ("2", None)], "`Col A` string, B string")
    path = os.path.join(tmp_dir, "landed")
    n1 = files.land_raw(df, path)
    n2 = files.land_raw(df, path)
    assert n1 == n2 == 2
    back = spark.read.parquet(path)
    assert back.columns == ["col_a", "b"]
    assert sorted(tuple(r) for r in back.collect()) == [("1", "a"), ("2", None)]


def test_export_marts_round_trip(spark, tmp_dir):
    marts = {"dim_school": spark.createDataFrame([(1, "A")], "URN int, Name string")}
    counts = files.export_marts(marts, tmp_dir)
    assert [(r["table_name"], r["n_rows"]) for r in counts.collect()] == [("dim_school", 1)]
    assert files.read_export(spark, tmp_dir, "dim_school").columns == ["urn", "name"]


def test_long_row_aborts(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "l.csv"), "a,b\n1,2\n3,4,5\n", "utf-8")
    with pytest.raises(Exception):
        files.read_ees_csv(spark, p).collect()


def test_single_line_mode_reads_the_same(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "s1.csv"), "A b,C\n1,x\n2,\n3,NA\n", "utf-8")
    a = sorted(tuple(r) for r in files.read_ees_csv(spark, p).collect())
    b = sorted(tuple(r) for r in files.read_ees_csv(spark, p, multi_line=False).collect())
    assert a == b == [("1", "x"), ("2", None), ("3", None)]
