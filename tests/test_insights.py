"""Hand fixtures for the quartile, correlation and trend-line traps."""

import pytest

from edustar.operators import insights as I

JOINED = "la_code string, avg_secondary_absence double, avg_attainment8 double"


def test_quartile_null_last_and_ties(spark):
    rows = [("005", None, 40.0), ("001", 9.0, 50.0), ("002", 8.0, 52.0), ("003", 8.0, 51.0), ("004", 10.0, 45.0)]
    q = I.absence_quartile(spark.createDataFrame(rows, JOINED))
    got = {r["la_code"]: r["absence_quartile"] for r in q.collect()}
    # order: 002 (8, la tie-break), 003 (8), 001 (9), 004 (10), 005 (NULL last); 5 rows -> 2,1,1,1
    assert got == {"002": 1, "003": 1, "001": 2, "004": 3, "005": 4}


def test_quartile_fewer_than_four(spark):
    rows = [("001", 9.0, 50.0), ("002", 8.0, 52.0)]
    q = I.absence_quartile(spark.createDataFrame(rows, JOINED))
    assert sorted(r["absence_quartile"] for r in q.collect()) == [1, 2]


def test_quartile_sizes_differ_by_at_most_one(spark):
    rows = [(f"{i:03d}", float(i % 7), 50.0) for i in range(23)]
    q = I.absence_quartile(spark.createDataFrame(rows, JOINED))
    sizes = [r[1] for r in q.groupBy("absence_quartile").count().collect()]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 23


def test_quartile_insight_keeps_null_mean_la(spark):
    att = spark.createDataFrame(
        [("001", "Secondary", 5.0), ("002", "Secondary", None), ("002", "Secondary", None)],
        "la_code string, phase string, pct_overall_absence double")
    dim = spark.createDataFrame([(1, "001", "A", True), (2, "002", "B", True)],
                                "urn int, la_code string, la_name string, is_secondary boolean")
    ks4 = spark.createDataFrame([(1, 50.0), (2, 40.0)], "urn int, attainment8_score double")
    got = [tuple(r) for r in I.insight_absence_quartiles(att, ks4, dim).collect()]
    assert got == [(1, 5.0, 50.0, 1), (2, None, 40.0, 1)]


CROSS = "avg_absence double, avg_attainment8 double"


@pytest.mark.parametrize("rows,expected", [
    ([], None),
    ([(1.0, 2.0)], None),
    ([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], None),          # constant x: no DIVIDE_BY_ZERO
    ([(1.0, 2.0), (None, 3.0), (2.0, None), (3.0, 6.0)], 1.0),  # NULL pairs dropped
    ([(1.0, 3.0), (2.0, 2.0), (3.0, 1.0)], -1.0),
])
def test_corr_degenerate_cases(spark, rows, expected):
    df = spark.createDataFrame(rows, CROSS)
    got = I.corr_absence_attainment(df).first()["corr"]
    assert got == expected


def test_trendline(spark):
    df = spark.createDataFrame([(1.0, 3.0), (2.0, 5.0), (3.0, 7.0), (None, 1.0)], CROSS)
    r = I.trendline(df).first()
    assert (r["slope"], r["intercept"], r["n_las"]) == (2.0, 1.0, 3)
    const = spark.createDataFrame([(1.0, 3.0), (1.0, 5.0)], CROSS)
    r = I.trendline(const).first()
    assert r["slope"] is None and r["intercept"] is None


def test_region_per_la_max_skips_null(spark):
    dim = spark.createDataFrame([("001", None), ("001", "London"), ("002", None)], "la_code string, region string")
    got = {r[0]: r[1] for r in I.region_per_la(dim).collect()}
    assert got == {"001": "London", "002": None}


def test_left_join_keeps_fact_rows(spark):
    att = spark.createDataFrame([("001", "Secondary", 5.0), ("999", "Secondary", 7.0)],
                                "la_code string, phase string, pct_overall_absence double")
    dim = spark.createDataFrame([("001", "London"), ("001", "London")], "la_code string, region string")
    assert I.join_attendance_region(att, dim).count() == 2
    got = {r["region"]: r["n_las"] for r in I.insight_absence_by_region(att, dim).collect()}
    assert got == {"London": 1, "(unmapped)": 1}
