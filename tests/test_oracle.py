"""Every catalog query against its DuckDB oracle at sf0.01 (the driver's gate, locally)."""

import pytest

from edustar.plans.catalog import oracle_sql, queries
from tests.conftest import SF01
from tests.oracle_compare import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    assert name in oracle_sql()
    r = compare(spark, con, SF01, name)
    assert r[1] == "ok", r


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() >= 0 and df.columns == ["region", "mean_secondary_absence", "n_las"]
