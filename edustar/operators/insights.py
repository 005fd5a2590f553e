"""Per-LA aggregates and the two published insights.

Grain rule: the attendance fact (LA x week x phase) and the school facts only meet at
LA level. The dimension is collapsed to one row per LA *before* any join with
attendance, and both facts are aggregated per LA *before* they meet, so no join ever
fans rows out.

Scale: every ``groupBy`` here runs as a partial + final aggregation, so a hot LA
(say a third of all rows) is pre-combined map-side and costs one row per map task
after the shuffle. The per-LA results are bounded by the number of LAs; Spark's AQE
measures them at runtime and broadcasts them into the next join when they fit its
threshold. Joins of a fact to a per-LA lookup go through ``lookup_join``, which salts
the fact side, so a hot LA is spread over many tasks even where no broadcast happens.
No explicit broadcast hint is used.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edustar.functions import label_unmapped
from edustar.operators.joins import lookup_join


# -- dimension collapsed to LA ------------------------------------------------

def region_per_la(dim: DataFrame) -> DataFrame:
    """One region per LA code: max(region); max skips NULL."""
    return dim.groupBy("la_code").agg(F.max("region").alias("region"))


def region_per_la_name(dim: DataFrame) -> DataFrame:
    """One region per LA name, NULL regions removed first."""
    return dim.where(F.col("region").isNotNull()).groupBy("la_name").agg(F.max("region").alias("region"))


# -- per-LA measures -------------------------------------------------------------

def absence_by_la(attendance: DataFrame, phase: str = "Secondary", alias: str = "avg_secondary_absence") -> DataFrame:
    """Unweighted mean of weekly overall absence per LA for one phase."""
    return (attendance.where(F.col("phase") == phase)
            .groupBy("la_code").agg(F.avg("pct_overall_absence").alias(alias)))


def attainment_by_la(ks4: DataFrame, dim: DataFrame) -> DataFrame:
    """Mean Attainment 8 per LA of the *dimension*, secondary schools only."""
    d = dim.where(F.col("is_secondary")).select("urn", "la_code", "la_name")
    f = ks4.select("urn", "attainment8_score")
    return (f.join(d, "urn", "inner")
            .groupBy("la_code")
            .agg(F.max("la_name").alias("la_name"), F.avg("attainment8_score").alias("avg_attainment8")))


def la_cross(attendance: DataFrame, ks4: DataFrame, dim: DataFrame) -> DataFrame:
    """Per LA: name, mean secondary absence, mean Attainment 8 (both facts, LA grain)."""
    a = absence_by_la(attendance, alias="avg_absence")
    t = attainment_by_la(ks4, dim)
    return a.join(t, "la_code", "inner").select("la_code", "la_name", "avg_absence", "avg_attainment8")


def la_joined(attendance: DataFrame, ks4: DataFrame, dim: DataFrame) -> DataFrame:
    """The insight's join: ``(la_code, avg_secondary_absence, avg_attainment8)``."""
    a = absence_by_la(attendance)
    t = attainment_by_la(ks4, dim).select("la_code", "avg_attainment8")
    return a.join(t, "la_code", "inner")


# -- insights ---------------------------------------------------------------------

def join_attendance_region(attendance: DataFrame, dim: DataFrame, la_region: DataFrame | None = None) -> DataFrame:
    """Every attendance row with its LA's region (left join keeps unknown LAs).

    ``la_region`` may be a stored ``region_per_la(dim)`` (the build writes one next to
    the marts) so the dimension is not re-aggregated per query.
    """
    lookup = region_per_la(dim) if la_region is None else la_region
    return lookup_join(attendance, lookup, "la_code", "left")


def insight_absence_by_region(attendance: DataFrame, dim: DataFrame, phase: str = "Secondary",
                              la_region: DataFrame | None = None) -> DataFrame:
    """Region, mean absence (2 places), number of LAs; highest absence first.

    The fact is folded to one row per LA (sum and count of the measure) before the
    region is attached, so fact rows never cross the network and the join pairs one
    row per LA on each side. The region mean is the sum of the LA sums over the sum of
    the LA counts (the mean of all weekly rows, as ``avg`` gives), and the LA count is
    the number of LA groups with a code (``count(distinct la_code)``).
    """
    per_la = (attendance.where(F.col("phase") == phase)
              .groupBy("la_code")
              .agg(F.sum("pct_overall_absence").alias("abs_sum"), F.count("pct_overall_absence").alias("abs_n")))
    j = per_la.join(region_per_la(dim) if la_region is None else la_region, "la_code", "left")
    return (j.groupBy(label_unmapped("region").alias("region"))
            .agg(F.round(F.try_divide(F.sum("abs_sum"), F.sum("abs_n")), 2).alias("mean_secondary_absence"),
                 F.count("la_code").alias("n_las"))
            .orderBy(F.desc_nulls_last("mean_secondary_absence"), F.asc("region")))


def absence_quartile(joined: DataFrame) -> DataFrame:
    """ntile(4) over LAs by mean absence, NULL means last, ties broken by LA code.

    The window has no partition clause, so Spark runs it in one task. Its input is
    one row per LA (``la_joined``), bounded by the number of LAs, never fact rows.
    """
    w = Window.orderBy(F.asc_nulls_last("avg_secondary_absence"), F.asc("la_code"))
    return joined.withColumn("absence_quartile", F.ntile(4).over(w))


def insight_absence_quartiles(attendance: DataFrame, ks4: DataFrame, dim: DataFrame) -> DataFrame:
    """Per absence quartile: mean absence, mean Attainment 8 (2 places), LAs."""
    q = absence_quartile(la_joined(attendance, ks4, dim))
    return (q.groupBy("absence_quartile")
            .agg(F.round(F.avg("avg_secondary_absence"), 2).alias("mean_absence_pct"),
                 F.round(F.avg("avg_attainment8"), 2).alias("mean_attainment8"),
                 F.count(F.lit(1)).alias("n_las"))
            .orderBy("absence_quartile"))


def _pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.where(F.col(x).isNotNull() & F.col(y).isNotNull())


def _varies(x: str, y: str):
    return (F.count(F.lit(1)) >= 2) & (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))


def corr_absence_attainment(cross: DataFrame, x: str = "avg_absence", y: str = "avg_attainment8",
                            places: int = 6) -> DataFrame:
    """Pearson correlation over LAs; NULL for fewer than two pairs or a constant side.

    Built from ``covar_samp / (stddev_samp * stddev_samp)`` with ``try_divide``: the
    built-in ``corr`` raises DIVIDE_BY_ZERO under ANSI on a constant column even
    inside a guard, because the aggregate is evaluated before the guard.
    """
    p = _pairs(cross, x, y)
    r = F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y))
    return p.agg(F.round(F.when(_varies(x, y), r), places).alias("corr"),
                 F.count(F.lit(1)).alias("n_las"))


def trendline(cross: DataFrame, x: str = "avg_absence", y: str = "avg_attainment8", places: int = 6) -> DataFrame:
    """Least-squares line y = slope * x + intercept; NULL for a degenerate input."""
    p = _pairs(cross, x, y)
    ok = _varies(x, y)
    return p.agg(F.round(F.when(ok, F.regr_slope(y, x)), places).alias("slope"),
                 F.round(F.when(ok, F.regr_intercept(y, x)), places).alias("intercept"),
                 F.count(F.lit(1)).alias("n_las"))


def national_absence(attendance: DataFrame, phase: str = "Secondary") -> DataFrame:
    """One national mean of weekly LA absence for the phase (2 places)."""
    return (attendance.where(F.col("phase") == phase)
            .agg(F.round(F.avg("pct_overall_absence"), 2).alias("national_absence")))


def attainment_spread(ks4: DataFrame, dim: DataFrame) -> DataFrame:
    """Lowest and highest LA mean Attainment 8 (2 places)."""
    t = attainment_by_la(ks4, dim)
    return t.agg(F.round(F.min("avg_attainment8"), 2).alias("min_attainment8"),
                 F.round(F.max("avg_attainment8"), 2).alias("max_attainment8"))
