"""Row numbers and tiles over range partitions against plain sorting."""
import random

import pytest
from pyspark.sql import functions as F

from edustar.operators.ranking import ntile, numbered


@pytest.mark.parametrize("n", [0, 1, 7, 500])
def test_numbers_follow_the_order(spark, n):
    rng = random.Random(n)
    rows = [(i, rng.choice([None, 1.5, 2.0, 2.0, rng.random()])) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, x double").repartition(5)
    got = numbered(df, [F.asc_nulls_last("x"), F.asc("id")], "place").collect()
    want = sorted(rows, key=lambda r: (r[1] is None, r[1] if r[1] is not None else 0, r[0]))
    assert [(r["id"], r["x"]) for r in sorted(got, key=lambda r: r["place"])] == want
    assert sorted(r["place"] for r in got) == list(range(n))


@pytest.mark.parametrize("n,tiles", [(10, 4), (3, 5), (8, 4), (1, 1), (0, 3)])
def test_tiles_are_sql_tiles(spark, n, tiles):
    df = spark.range(n).withColumn("k", (F.col("id") * 7) % 11)
    got = sorted((r["k"], r["tile"]) for r in ntile(df, tiles, [F.asc("k"), F.asc("id")], "tile").collect())
    small, larger = divmod(n, tiles)
    want = [t + 1 for t in range(tiles) for _ in range(small + (t < larger))]
    assert [t for _, t in got] == want


def test_no_window_over_the_rows(spark):
    plan = ntile(spark.range(100), 4, [F.asc("id")], "tile")._jdf.queryExecution().executedPlan().toString()
    assert "ntile" not in plan and "row_number" not in plan
