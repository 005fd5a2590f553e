"""Hand fixtures for the four check kinds and the severities."""

import pytest

from edustar.operators import checks as C


def test_unique_counts_duplicated_values_not_rows(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (2,), (2,), (3,), (None,), (None,)], "urn int")
    r = C.dq_unique(df, "t", "urn").first()
    assert (r["failures"], r["status"]) == (2, "fail")
    assert C.unique_failures(df, "urn").count() == 2


def test_not_null_one_pass_many_columns(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "a")], "a int, b string")
    got = {r["column_name"]: r["failures"] for r in C.dq_not_null(df, "t", ["a", "b"]).collect()}
    assert got == {"a": 1, "b": 2}


def test_accepted_values_null_passes(spark):
    df = spark.createDataFrame([("Primary",), (None,), ("Nope",)], "phase string")
    assert C.dq_accepted_values(df, "t", "phase", ["Primary"]).first()["failures"] == 1


def test_relationships_orphans_and_null_child(spark):
    child = spark.createDataFrame([("001",), ("002",), ("002",), (None,)], "la_code string")
    parent = spark.createDataFrame([("001",), ("001",), (None,)], "la_code string")
    r = C.dq_relationships(child, "f", "la_code", parent, "la_code").first()
    assert (r["failures"], r["severity"], r["status"]) == (2, "warn", "warn")
    semi = child.join(parent, "la_code", "left_semi").count()
    anti = C.relationships_failures(child, "la_code", parent, "la_code").count()
    assert semi + anti == child.where("la_code is not null").count()


def test_raise_on_error_only_for_errors(spark):
    warn = C.dq_relationships(spark.createDataFrame([("9",)], "k string"), "f", "k",
                              spark.createDataFrame([("1",)], "k string"), "k")
    C.raise_on_error(warn)
    err = C.dq_unique(spark.createDataFrame([(1,), (1,)], "k int"), "t", "k")
    with pytest.raises(C.DataCheckError):
        C.raise_on_error(err)


def test_range(spark):
    df = spark.createDataFrame([(10.0,), (95.0,), (None,)], "s double")
    assert C.dq_range(df, "t", "s", 0, 90).first()["failures"] == 1


def test_one_pass_table_checks_equal_separate_checks(spark):
    df = spark.createDataFrame(
        [(1, "001", "Primary"), (1, None, "Nope"), (2, "002", None), (None, "003", "Primary"), (None, None, "X"),
         (3, "004", "Secondary"), (3, "004", "Secondary"), (3, "005", "Secondary")],
        "urn int, la_code string, phase string")
    one = {(r["column_name"], r["check_name"]): (r["failures"], r["status"]) for r in C.table_checks(
        df, "t", "urn", ["urn", "la_code"], {"phase": ["Primary", "Secondary"]}).collect()}
    sep = C._union([C.dq_unique(df, "t", "urn"), C.dq_not_null(df, "t", ["urn", "la_code"]),
                    C.dq_accepted_values(df, "t", "phase", ["Primary", "Secondary"])])
    two = {(r["column_name"], r["check_name"]): (r["failures"], r["status"]) for r in sep.collect()}
    assert one == two
    assert one[("urn", "unique")] == (2, "fail")
    assert one[("la_code", "not_null")] == (2, "fail")
    assert one[("phase", "accepted_values")] == (2, "fail")


def test_table_checks_empty_table(spark):
    df = spark.createDataFrame([], "urn int, la_code string")
    rows = C.table_checks(df, "t", "urn", ["urn", "la_code"]).collect()
    assert sorted((r["column_name"], r["check_name"], r["failures"], r["status"]) for r in rows) == [
        ("la_code", "not_null", 0, "pass"), ("urn", "not_null", 0, "pass"), ("urn", "unique", 0, "pass")]


def test_year_form(spark):
    df = spark.createDataFrame([(2022,), (202324,), (None,), (999,)], "academic_year int")
    r = C.dq_year_form(df, "t").first()
    assert (r["failures"], r["status"], r["check_name"]) == (2, "warn", "year_form")
