"""Two-phase publishing: readers keep the old version until a new one is whole and checked; digests show any change."""
import os

import pytest
from pyspark.sql import functions as F

from edustar.operators.checks import DataCheckError, dq_summary
from edustar.plans import pipeline
from edustar.plans.pipeline import Warehouse
from edustar.sources import files, manifest
from tests.conftest import SF001


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture()
def built(spark, tmp_dir):
    return Warehouse(spark, SF001, root=os.path.join(tmp_dir, "wh")).build(check=True)


def test_nothing_is_read_before_the_first_publish(spark, tmp_dir):
    with pytest.raises(RuntimeError, match="nothing is published"):
        Warehouse(spark, SF001, root=os.path.join(tmp_dir, "none")).dim


def test_a_failing_check_keeps_the_old_marts(spark, built, monkeypatch):
    before, old = built.version, rows(built.dim)
    whole = pipeline.RAW_BUILDERS["raw_gias"]
    monkeypatch.setitem(pipeline.RAW_BUILDERS, "raw_gias", lambda s, d: whole(s, d).withColumn(
        "phase_name", F.when(F.col("phase_name") == "Primary", "Unknown phase").otherwise(F.col("phase_name"))))
    other = Warehouse(spark, SF001, root=built.root)
    with pytest.raises(DataCheckError, match="accepted_values"):
        other.build(check=True)
    assert manifest.current(spark, built.root) == before
    assert rows(Warehouse(spark, SF001, root=built.root).dim) == old


def test_a_build_that_stops_half_way_is_never_read(spark, built, monkeypatch):
    before = built.version

    def stop(*a):
        raise OSError("disk gone")
    monkeypatch.setitem(pipeline.RAW_BUILDERS, "raw_ks4", stop)
    with pytest.raises(OSError):
        Warehouse(spark, SF001, root=built.root).build()
    assert manifest.current(spark, built.root) == before


def test_a_new_version_leaves_open_readers_on_theirs(spark, built):
    reader = Warehouse(spark, SF001, root=built.root)
    held, first = reader.ks4, reader.version
    built.build()
    assert built.version != first == reader.version
    assert rows(held) == rows(built.ks4)
    assert reader.refresh().version == built.version


def test_observed_checks_equal_the_scans(built):
    assert rows(built.checked()) == rows(dq_summary(built.tables()))
    assert rows(files.load_counts(built.metrics)) == [(n, built.raw(n).count()) for n in ("raw_attendance", "raw_gias", "raw_ks4")]


def test_digest_shows_changes_and_ignores_order(spark):
    df = spark.createDataFrame([(1, "a", 0.5), (2, None, None), (2, "", 1.25), (2, "", 1.25)], "k int, `v w` string, x double")
    one = lambda d: tuple(files.content_digest(d, "t").first())
    assert one(df) == one(df.select("x", "k", "v w").orderBy(F.desc("k")))
    changed = [df.dropDuplicates(), df.withColumn("x", F.when(F.col("k") == 1, 0.500001).otherwise(F.col("x"))),
               df.withColumn("v w", F.coalesce("v w", F.lit(""))), df.withColumn("k", F.col("k") + 1)]
    assert len({one(d) for d in [df, *changed]}) == 5
    assert one(df.limit(0)) == ("t", 0, "0")


def test_export_is_published(spark, built, tmp_dir):
    out = os.path.join(tmp_dir, "export")
    marts = {n: built.mart(n) for n in built.MARTS}
    first = rows(files.export_marts(marts, out))
    assert first == rows(files.content_digests(marts))
    files.export_marts({n: df.limit(3) for n, df in marts.items()}, out)
    assert files.read_export(spark, out, "dim_school").count() == 3
