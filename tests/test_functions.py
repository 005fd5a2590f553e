"""Hand fixtures for the column helpers (casts, codes, keys, period labels)."""

import pytest
from pyspark.errors import ArithmeticException, NumberFormatException

from edustar.functions import (
    flag_secondary, label_unmapped, pad_code, period_index, period_label, school_label, strict_int,
    suppressed_to_null, surrogate_key, try_int, week_number, year_label,
)


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_suppressed_to_null(spark):
    texts = ["c", "x", "z", "low", "", " 12.5 ", "1e3", "5d", "12.5f", "NaN", "Infinity", "-3", ".5", "7.", None]
    got = _one(spark, [(t,) for t in texts], "v string", suppressed_to_null("v"))
    assert got == [None, None, None, None, None, 12.5, 1000.0, None, None, None, None, -3.0, 0.5, 7.0, None]


def test_try_int(spark):
    got = _one(spark, [(t,) for t in ["3.7", "1,000", " 12 ", "z", "4000", None]], "v string", try_int("v"))
    assert got == [None, None, 12, None, 4000, None]


def test_strict_int_raises_on_bad_text(spark):
    df = spark.createDataFrame([("12",), ("c",)], "v string").select(strict_int("v"))
    with pytest.raises((NumberFormatException, ArithmeticException, Exception)) as e:
        df.collect()
    assert "CAST_INVALID_INPUT" in str(e.value)


def test_pad_code_pads_and_cuts(spark):
    got = _one(spark, [(t,) for t in ["9", "012", "12345", None]], "v string", pad_code("v"))
    assert got == ["009", "012", "123", None]


def test_surrogate_key_null_part_and_order(spark):
    rows = [("001", 2022, "Week 1", "Primary"), ("001", 2022, None, "Primary"),
            ("Primary", 2022, "Week 1", "001")]
    got = _one(spark, rows, "a string, y int, w string, p string", surrogate_key("a", "y", "w", "p"))
    import hashlib
    assert got[0] == hashlib.md5(b"001|2022|Week 1|Primary").hexdigest()
    assert got[1] is None
    assert got[2] != got[0]


def test_equal_parts_give_equal_keys(spark):
    rows = [("001", 2022), ("001", 2022)]
    got = _one(spark, rows, "a string, y int", surrogate_key("a", "y"))
    assert got[0] == got[1]


def test_week_number(spark):
    got = _one(spark, [(t,) for t in ["Week 1", "Week 12", "Summer", None]], "v string", week_number("v"))
    assert got == [1, 12, None, None]


def test_year_and_period_labels(spark):
    rows = [(1999, "Week 5"), (2022, "Week 12"), (2022, "Summer"), (2022, "Week 123")]
    df = spark.createDataFrame(rows, "academic_year int, week_label string")
    got = [tuple(r) for r in df.select(year_label(), period_index(), period_label()).collect()]
    assert got == [("1999/00", 199905, "1999/00 W05"), ("2022/23", 202212, "2022/23 W12"),
                   ("2022/23", 202200, "2022/23 W00"), ("2022/23", 202323, "2022/23 W123")]


def test_flag_secondary_three_valued(spark):
    got = _one(spark, [(t,) for t in ["Secondary", "All-through", "Primary", None]], "p string", flag_secondary("p"))
    assert got == [True, True, False, None]


def test_labels(spark):
    assert _one(spark, [(None,), ("London",)], "r string", label_unmapped("r")) == ["(unmapped)", "London"]
    got = _one(spark, [("A", None), (None, "B")], "school_name string, la_name string", school_label())
    assert got == ["A — ?", "? — B"]
