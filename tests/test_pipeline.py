"""The build on the driver tables: expected sizes (FIXTURES 2.5) and properties."""

import pytest
from pyspark.sql import functions as F

from edustar.operators import insights as I
from edustar.operators import staging as ST
from edustar.plans.pipeline import warehouse
from tests.conftest import SF001


@pytest.fixture(scope="module")
def wh(spark):
    return warehouse(spark, SF001)


def test_raw_sizes(wh):
    assert [wh.raw(n).count() for n in ("raw_gias", "raw_attendance", "raw_ks4")] == [150, 14083, 794]


def test_dimension(wh):
    d = wh.dim
    assert d.count() == 85
    assert d.select(F.count_distinct("la_code")).first()[0] == 24
    assert d.where("region is null").count() == 15
    assert d.where("is_secondary").count() == 35


def test_attendance_fact(wh):
    a = wh.attendance
    r = a.agg(F.count(F.lit(1)), F.count_distinct("attendance_key"), F.count_distinct("la_code"),
              F.sum("possible_sessions"), F.count("pct_overall_absence")).first()
    assert tuple(r) == (2904, 2904, 25, 4822320, 2746)


def test_ks4_fact(wh):
    k = wh.ks4
    assert tuple(k.agg(F.count(F.lit(1)), F.count_distinct("urn"), F.count("attainment8_score")).first()) == (150, 150, 148)


def test_insight_figures(wh):
    cross = I.la_cross(wh.attendance, wh.ks4, wh.dim)
    assert cross.count() == 18 and cross.where("avg_absence is not null").count() == 17
    r = I.corr_absence_attainment(cross).first()
    assert r["corr"] == pytest.approx(-0.393705, abs=1e-6)
    t = I.trendline(cross).first()
    assert t["slope"] == pytest.approx(-0.855913, abs=1e-6)
    assert t["intercept"] == pytest.approx(92.552097, abs=1e-6)


def test_raising_threshold_never_adds_rows(wh):
    raw = wh.raw("raw_attendance")
    counts = [ST.stg_attendance(raw, m).count() for m in (0, 1000, 5000, 10 ** 9)]
    assert counts == sorted(counts, reverse=True)


def test_key_uniqueness_equals_grain_uniqueness(wh):
    a = wh.attendance
    grain = a.select("la_code", "academic_year", "week_label", "phase").distinct().count()
    assert a.select("attendance_key").distinct().count() == grain == a.count()


def test_left_join_keeps_fact_rows(wh):
    assert I.join_attendance_region(wh.attendance, wh.dim).count() == wh.attendance.count()


def test_anti_plus_semi_equals_child_rows(wh):
    f, d = wh.ks4, wh.dim
    anti = f.join(d.select("urn"), "urn", "left_anti").count()
    semi = f.join(d.select("urn"), "urn", "left_semi").count()
    assert anti + semi == f.where("urn is not null").count()
    assert anti == 65


def test_year_partitioned_facts_give_the_same_answers(spark, wh, tmp_path):
    import os

    from edustar.operators import views as V
    from edustar.plans.pipeline import Warehouse

    def same(a, b):
        b = b.select(*a.columns)
        return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0

    part = Warehouse(spark, SF001, root=os.path.join(str(tmp_path), "p"), partition_facts_by_year=True).build()
    for m in ("fct_attendance_weekly", "fct_ks4_results"):
        assert same(wh.mart(m), part.mart(m)) and wh.mart(m).columns == part.mart(m).columns
    q = V.filter_view(V.attendance_enriched(part.attendance, part.dim), "Secondary", None, ["1995/96"])
    base = V.filter_view(V.attendance_enriched(wh.attendance, wh.dim), "Secondary", None, ["1995/96"])
    assert base.count() > 0 and same(base, q)
    plan = part.attendance.where(F.col("academic_year") == 1995)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(academic_year" in plan
    assert same(I.insight_absence_quartiles(wh.attendance, wh.ks4, wh.dim),
                I.insight_absence_quartiles(part.attendance, part.ks4, part.dim))


def test_stored_lookups_equal_computed(wh):
    for stored, computed in ((wh.la_region, I.region_per_la(wh.dim)),
                             (wh.la_region_by_name, I.region_per_la_name(wh.dim))):
        assert stored.exceptAll(computed).count() == 0 and computed.exceptAll(stored).count() == 0


def test_session_guard_counts(spark):
    from edustar.plans.catalog import QUERIES
    from tests.conftest import SF01
    assert QUERIES["session_guard_under_threshold"](spark, SF01).count() == 3827
    assert QUERIES["session_guard_dropped"](spark, SF01).count() >= 3827
