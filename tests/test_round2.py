"""Session, casts, screen and check rules added after the first round."""
import pytest
from pyspark.sql import functions as F

from edustar.functions import strict_int
from edustar.operators import checks as C
from edustar.operators import screen as S
from edustar.operators import views as V
from edustar.plans.pipeline import warehouse
from edustar.sources import files

from tests.conftest import SF001


@pytest.fixture(scope="module")
def marts(spark):
    wh = warehouse(spark, SF001)
    return {n: wh.mart_path(n) for n in wh.MARTS}


@pytest.mark.parametrize("text", [
    "select reflect('java.lang.System', 'getProperty', 'user.home')",
    "select java_method('java.lang.System', 'getProperty', 'user.home') from dim_school",
    "select urn from dim_school where urn in (select try_reflect('java.lang.System', 'getProperty', 'x'))",
    "select * from global_temp.hidden", "select * from range(5)", "select * from values (1), (2)",
    "select input_file_name() from dim_school", "select * from parquet.`/root/testdata/sf0.001/nation.parquet`",
    "select * from nowhere"])
def test_run_screened_is_confined(spark, marts, text):
    spark.range(3).createOrReplaceGlobalTempView("hidden")
    with pytest.raises(S.ScreenError):
        S.run_screened(spark, text, marts)


def test_run_screened_runs_and_caps(spark, marts):
    got = S.run_screened(spark, "with d as (select urn, la_code from dim_school) select d.urn, f.phase from d "
                                "join fct_attendance_weekly f on f.la_code = d.la_code", marts, n=7)
    assert got.count() == 7
    assert S.run_screened(spark, "select 'limit' as x from dim_school", marts, n=3).count() == 3


@pytest.mark.parametrize("text, want", [
    ("```sql\nselect 1\n```", "select 1"), ("```\nselect 1;\n```", "select 1"), ("  select 1 ;; ", "select 1"), (None, ""),
    ("```SQL select 1```", "select 1"), ("select '```' as x", "select '```' as x"), ("", "")])
def test_clean_answer(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(S.clean_answer("t").alias("c")).first()["c"]
    assert got == want


def test_strict_int_raises_without_ansi(spark):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        df = spark.createDataFrame([("12",), (None,), ("abc",)], "v string")
        assert [r[0] for r in df.where("v is null or v = '12'").select(strict_int("v")).collect()] == [12, None]
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            df.select(strict_int("v")).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_get_session_keeps_a_running_master(spark):
    from edustar.session import get_session
    assert get_session().sparkContext.master == spark.sparkContext.master


def test_anti_join_on_a_near_unique_key_copies_nothing(spark):
    child, parent = spark.createDataFrame([("1",), ("9",), (None,)], "k string"), spark.createDataFrame([("1",), ("1",), (None,)], "k string")
    got = C.relationships_failures(child, "k", parent, "k")
    assert [r[0] for r in got.collect()] == ["9"]
    assert "Generate" not in got._jdf.queryExecution().toString()


def test_checks_fail_on_bad_tables(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 99.0), (None, 5.0), ("z", None)], "k string, x double")
    rows = [C.dq_unique(df, "t", "k"), C.dq_not_null(df, "t", ["k"]), C.dq_accepted_values(df, "t", "k", ["a"]), C.dq_range(df, "t", "x", 0, 90)]
    assert [(r.first()["failures"], r.first()["status"]) for r in rows] == [(1, "fail"), (1, "fail"), (1, "fail"), (1, "warn")]


def test_large_csv_splits(spark, tmp_dir):
    with open(f"{tmp_dir}/big.csv", "w") as f:
        f.write("A B,c\n" + "".join(f"{i},{'x' * 90}\n" for i in range(60_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        one = files.read_ees_csv(spark, f"{tmp_dir}/big.csv", multi_line=True)
        many = files.read_ees_csv(spark, f"{tmp_dir}/big.csv")
        assert one.rdd.getNumPartitions() == 1 and many.rdd.getNumPartitions() > 3
        assert one.count() == many.count() == 60_000 and many.columns == ["a_b", "c"]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_headline_plan_has_no_expand(spark):
    wh = warehouse(spark, SF001)
    plan = V.attendance_headline(V.attendance_enriched(wh.attendance, wh.dim))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("Join")  # facts fold before anything is expanded


def test_orders(spark):
    wh = warehouse(spark, SF001)
    trend = [(r["period_idx"], r["region"]) for r in V.absence_trend(V.attendance_enriched(wh.attendance, wh.dim)).collect()]
    assert trend == sorted(trend)
    rank = [r["mean_absence"] for r in V.absence_rank(V.attendance_enriched(wh.attendance, wh.dim)).collect()]
    assert rank == sorted(rank, reverse=True)
    labels = [r["label"] for r in V.school_labels(V.schools_enriched(wh.ks4, wh.dim)).collect()]
    assert labels == sorted(labels)
