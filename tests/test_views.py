"""Hand fixtures for the dashboard views: filters, search, compare."""

from edustar.operators import views as V

ENR = "region string, phase string, year_label string, period_idx int, period_label string, pct_overall_absence double"
ROWS = [("London", "Secondary", "2022/23", 202201, "2022/23 W01", 8.0),
        ("North East", "Secondary", "2023/24", 202301, "2023/24 W01", 10.0),
        ("(unmapped)", "Secondary", "2022/23", 202201, "2022/23 W01", 99.0),
        ("London", "Primary", "2022/23", 202201, "2022/23 W01", 5.0)]


def test_filter_view_empty_lists_mean_all_mapped(spark):
    df = spark.createDataFrame(ROWS, ENR)
    assert V.filter_view(df, "Secondary", [], []).count() == 2
    assert V.filter_view(df, "Secondary").count() == 2
    assert V.filter_view(df, "Secondary", ["(unmapped)"]).count() == 1
    assert V.filter_view(df, "Secondary", None, ["2023/24"]).count() == 1


def test_headline_on_empty_view_is_null(spark):
    df = spark.createDataFrame(ROWS, ENR)
    r = V.attendance_headline(V.filter_view(df, "Special")).first()
    assert r["mean_absence"] is None and r["n_regions"] == 0 and r["n_periods"] == 0


def test_trend_and_rank(spark):
    df = V.filter_view(spark.createDataFrame(ROWS, ENR), "Secondary")
    assert [tuple(r) for r in V.absence_rank(df).collect()] == [("North East", 10.0), ("London", 8.0)]
    assert V.absence_trend(df).count() == 2


SCH = "urn int, school_name string, la_name string, region string, attainment8_score double, " \
      "pct_grade5_eng_maths double, ebacc_aps double"
SCHOOLS = [(3, "St. Mary's", "Surrey", "South East", 50.0, 60.0, 4.0),
           (1, "Ash Manor School", "Surrey", None, None, 55.0, 3.5),
           (2, "STX MARYS", "Kent", "South East", 45.0, None, 3.0),
           (4, None, "Kent", "South East", 40.0, 50.0, 2.0),
           (5, "St. Mary's", "Surrey", "South East", 70.0, 61.0, 5.0)]


def test_search_case_regex_null_and_empty(spark):
    df = spark.createDataFrame(SCHOOLS, SCH)
    assert sorted(r.urn for r in V.search_name(df, "st. mary").collect()) == [2, 3, 5]  # '.' is a regex dot
    assert V.search_name(df, "").count() == 5
    assert V.search_name(df, None).count() == 5
    assert sorted(r.urn for r in V.search_ilike(df, "ash").collect()) == [1]


def test_school_headline_skips_null_scores(spark):
    r = V.school_headline(spark.createDataFrame(SCHOOLS, SCH)).first()
    assert r["n_schools"] == 5 and r["mean_attainment8"] == (50 + 45 + 40 + 70) / 4


def test_schools_by_score_columns_and_null_last(spark):
    out = V.schools_by_score(spark.createDataFrame(SCHOOLS, SCH))
    assert out.columns == ["School", "LA", "Region", "Attainment 8", "% grade 5+ E&M", "EBacc APS"]
    scores = [r["Attainment 8"] for r in out.collect()]
    assert scores == [70.0, 50.0, 45.0, 40.0, None]


def test_top_k(spark):
    got = [r.urn for r in V.top_k_schools(spark.createDataFrame(SCHOOLS, SCH), "Surrey", k=5).collect()]
    assert got == [5, 3]


def test_compare_duplicate_label_null_measure(spark):
    df = spark.createDataFrame(SCHOOLS, SCH)
    r = V.compare_schools(df, "St. Mary's — Surrey", "STX MARYS — Kent").first()
    assert r["a_urn"] == 3  # duplicate label: smallest urn wins
    assert r["b_urn"] == 2
    assert r["delta_attainment8_score"] == -5.0
    assert r["delta_pct_grade5_eng_maths"] is None
    assert V.first_match(df, "St. Mary's — Surrey").first()["urn"] == 3


def test_compare_same_label_and_missing(spark):
    df = spark.createDataFrame(SCHOOLS, SCH)
    r = V.compare_schools(df, "? — Kent", "? — Kent").first()
    assert r["a_urn"] == r["b_urn"] == 4 and r["delta_ebacc_aps"] == 0.0
    assert V.compare_schools(df, "nope — x", "? — Kent").count() == 0


def test_labels_sorted_distinct(spark):
    got = [r.label for r in V.school_labels(spark.createDataFrame(SCHOOLS, SCH)).collect()]
    assert got == sorted(set(got)) and len(got) == 4


def test_compare_with_null_region(spark):
    df = spark.createDataFrame(SCHOOLS, SCH)
    r = V.compare_schools(df, "Ash Manor School — Surrey", "St. Mary's — Surrey").first()
    assert r["a_region"] is None and r["b_region"] == "South East"
    assert r["delta_attainment8_score"] is None  # A has no score
    assert r["delta_pct_grade5_eng_maths"] == 5.0


def test_year_choice_reaches_the_scan(spark, tmp_dir):
    import os
    rows = [("001", 2022, "Week 1", "Secondary", 5.0), ("001", 2023, "Week 1", "Secondary", 7.0)]
    path = os.path.join(tmp_dir, "fact")
    spark.createDataFrame(rows, "la_code string, academic_year int, week_label string, phase string, "
                                "pct_overall_absence double").write.parquet(path)
    dim = spark.createDataFrame([("001", "London")], "la_code string, region string")
    view = V.filter_view(V.attendance_enriched(spark.read.parquet(path), dim), "Secondary", None, ["2023/24", "bad"])
    assert [r.pct_overall_absence for r in view.collect()] == [7.0]
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    plan = view._jdf.queryExecution().explainString(mode)
    assert "EqualTo(academic_year,2023)" in plan
