"""The dashboard queries from stored roll-ups: the same answers as from the fact, without reading it."""

import pytest

from edustar.operators import views as V
from edustar.plans.catalog import QUERIES
from edustar.plans.pipeline import warehouse
from tests.conftest import SF001


@pytest.fixture(scope="module")
def wh(spark):
    return warehouse(spark, SF001)


WEEK = ("region", "academic_year", "week_label", "phase")
YEAR = ("region", "academic_year", "phase")


@pytest.mark.parametrize("answer,needed", [(V.absence_trend, WEEK), (V.absence_rank, YEAR), (V.attendance_headline, WEEK)])
@pytest.mark.parametrize("choice", [("Secondary",), ("Primary", ["ASIA", "(unmapped)"], ["1995/96"]), ("No such phase",)])
def test_rollups_answer_as_the_fact_does(wh, answer, needed, choice):
    key = lambda rows: sorted(map(tuple, rows), key=str)
    assert key(answer(V.filter_view(wh.attendance_view(*needed), *choice)).collect()) == key(answer(V.filter_view(wh.enriched, *choice)).collect())


def test_filter_options(wh):
    assert V.filter_options(wh.attendance_view(*YEAR)).collect() == V.filter_options(wh.enriched).collect()


@pytest.mark.parametrize("name", ["absence_trend", "absence_rank", "attendance_headline", "filter_options"])
def test_no_plan_reads_the_fact(spark, wh, name):
    files = QUERIES[name](spark, SF001).inputFiles()
    assert files and not any("fct_attendance" in f for f in files)


def test_the_smallest_rollup_that_answers():
    sizes = {"region_week": 900, "region_year": 40}
    assert V.smallest_rollup(YEAR, sizes) == "region_year"
    assert V.smallest_rollup(WEEK, sizes) == "region_week"
    assert V.smallest_rollup(("la_code", "phase"), sizes) is None
    assert V.smallest_rollup(("phase",), {"region_week": 10, "region_year": 40}) == "region_week"


def test_other_columns_come_from_the_fact(wh):
    assert "pct_overall_absence" in wh.attendance_view("la_code").columns
