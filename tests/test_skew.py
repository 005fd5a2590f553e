"""A hot key: one LA holds 40% of the fact rows.

With broadcasts switched off, the LA join is a sort-merge join whose lookup side is an
aggregate, where AQE's skew split cannot apply; the salted lookup join must spread the
hot LA over many partitions, and the per-LA aggregation must pre-combine it map-side.
The results must equal a brute-force pandas computation.
"""

import os

import pandas as pd
import pytest

from edustar.operators import checks as C
from edustar.operators import insights as I

N = 40_000


@pytest.fixture()
def skewed(spark, tmp_dir):
    from pyspark.sql import functions as F
    ids = spark.range(N)
    la = F.when(F.col("id") % 10 < 4, F.lit("001")).otherwise(F.lpad((F.col("id") % 97 + 2).cast("string"), 3, "0"))
    fact = ids.select(
        la.alias("la_code"),
        F.when(F.col("id") % 3 == 0, "Secondary").otherwise("Primary").alias("phase"),
        (F.col("id") % 50).cast("double").alias("pct_overall_absence"),
        F.col("id").cast("string").alias("attendance_key"))
    dim = spark.range(2000).select(
        F.lpad((F.col("id") % 90 + 1).cast("string"), 3, "0").alias("la_code"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.concat(F.lit("R"), (F.col("id") % 7).cast("string"))).alias("region"))
    fp, dp = os.path.join(tmp_dir, "fact"), os.path.join(tmp_dir, "dim")
    fact.repartition(8).write.parquet(fp)
    dim.write.parquet(dp)
    return spark.read.parquet(fp), spark.read.parquet(dp)


@pytest.fixture()
def no_broadcast_low_skew(spark):
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def _run_and_plan(df):
    """Collect through the frame's own execution, then read its final adaptive plan."""
    rows = df.collect()
    jvm = df.sparkSession._jvm
    plan = df._jdf.queryExecution().explainString(jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "isFinalPlan=true" in plan
    return rows, plan


def test_hot_la_join_is_split_and_exact(spark, skewed, no_broadcast_low_skew):
    fact, dim = skewed
    joined = I.join_attendance_region(fact, dim)
    rows, plan = _run_and_plan(joined)
    assert "SortMergeJoin" in plan and "__salt" in plan
    got = pd.DataFrame([r.asDict() for r in rows])
    f, d = fact.toPandas(), dim.toPandas()
    reg = d.groupby("la_code", as_index=False)["region"].max()
    want = f.merge(reg, on="la_code", how="left")
    assert len(got) == len(want) == N
    key = ["attendance_key"]
    g = got.sort_values(key).reset_index(drop=True)[["attendance_key", "la_code", "region"]]
    w = want.sort_values(key).reset_index(drop=True)[["attendance_key", "la_code", "region"]]
    pd.testing.assert_frame_equal(g.fillna("<null>"), w.fillna("<null>"), check_dtype=False)


def test_hot_la_aggregates_are_exact(spark, skewed, no_broadcast_low_skew):
    fact, dim = skewed
    got = {r["region"]: (r["mean_secondary_absence"], r["n_las"])
           for r in I.insight_absence_by_region(fact, dim).collect()}
    f, d = fact.toPandas(), dim.toPandas()
    reg = d.groupby("la_code", as_index=False)["region"].max()
    sec = f[f.phase == "Secondary"].merge(reg, on="la_code", how="left")
    sec["region"] = sec["region"].fillna("(unmapped)")
    want = sec.groupby("region").agg(m=("pct_overall_absence", "mean"), n=("la_code", "nunique"))
    assert got == {k: (round(v.m, 2), v.n) for k, v in want.iterrows()}


def test_hot_key_anti_join_and_unique(spark, skewed, no_broadcast_low_skew):
    fact, dim = skewed
    anti = C.relationships_failures(fact, "la_code", dim, "la_code").count()
    f, d = fact.toPandas(), dim.toPandas()
    assert anti == int((~f.la_code.isin(set(d.la_code))).sum())
    r = C.dq_unique(fact, "f", "la_code").first()
    assert r["failures"] == f.la_code.value_counts().gt(1).sum()


def test_salt_spreads_hot_key_and_identical_copies(spark, no_broadcast_low_skew, tmp_dir):
    from pyspark.sql import functions as F
    from edustar.operators.joins import lookup_join
    # 30,000 identical copies of one row plus 1,000 other keys, stored as Parquet
    path = os.path.join(tmp_dir, "copies")
    (spark.range(31_000).select(F.when(F.col("id") < 30_000, F.lit("001"))
                                .otherwise(F.format_string("%03d", F.col("id") % 1000)).alias("k"))
     .write.parquet(path))
    big = spark.read.parquet(path)
    lookup = big.select("k").distinct().withColumn("v", F.lit(1))
    j = lookup_join(big, lookup, "k", "inner")
    per_task = [r[0] for r in j.groupBy(F.spark_partition_id()).count().select("count").collect()]
    assert sum(per_task) == 31_000
    hot = j.where("k = '001'").groupBy(F.spark_partition_id()).count().collect()
    assert len(hot) > 1  # the hot key is not in one task


def test_salt_keeps_filter_pushdown(spark, skewed):
    fact, dim = skewed
    q = I.join_attendance_region(fact, dim).where("phase = 'Secondary'")
    _, plan = _run_and_plan(q)
    assert "EqualTo(phase,Secondary)" in plan


def test_lookup_join_null_keys_and_kinds(spark):
    from edustar.operators.joins import lookup_join
    big = spark.createDataFrame([("001", 1), (None, 2), ("009", 3), ("001", 4)], "k string, v int")
    lookup = spark.createDataFrame([("001", "A"), (None, "N")], "k string, r string")
    left = sorted((r.v, r.r) for r in lookup_join(big, lookup, "k", "left").collect())
    assert left == [(1, "A"), (2, None), (3, None), (4, "A")]
    assert sorted(r.v for r in lookup_join(big, lookup, "k", "inner").collect()) == [1, 4]
    assert sorted(r.v for r in lookup_join(big, lookup, "k", "left_anti").collect()) == [2, 3]
    assert sorted(r.v for r in lookup_join(big, lookup, "k", "left_semi").collect()) == [1, 4]
    assert lookup_join(big, lookup, "k", "left").columns == ["k", "v", "r"]
