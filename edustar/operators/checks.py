"""Data checks: four kinds, two severities, one summary row per check.

Each kind has a ``*_failures`` function returning the failing rows (for inspection)
and a summary function returning one row
``(model, column_name, check_name, severity, failures, status)``.

Cost at scale: all not-null checks of a table share one aggregate pass; a uniqueness
check is one partial+final aggregation on its key (a hot key is pre-combined map-side);
a relationship check is one anti join of child rows against the *distinct* parent
keys, which AQE broadcasts when the measured parent side is small; it is salted
(``lookup_join``) so a hot child key spreads over many tasks when it is not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from edustar.operators.joins import lookup_join
from edustar.schema import ATTENDANCE_PHASES, SCHOOL_PHASES

SUMMARY_COLUMNS = ("model", "column_name", "check_name", "severity", "failures", "status")


def _status(severity: str):
    f = F.col("failures")
    return (F.when(f == 0, "pass").when(F.lit(severity) == "warn", "warn").otherwise("fail"))


def _summary(counted: DataFrame, model: str, check: str, severity: str, column=None) -> DataFrame:
    """``counted`` has ``failures`` (and ``column_name`` when many columns share a pass)."""
    col = F.col("column_name") if column is None else F.lit(column)
    return counted.select(
        F.lit(model).alias("model"), col.alias("column_name"), F.lit(check).alias("check_name"),
        F.lit(severity).alias("severity"), F.col("failures").cast("bigint").alias("failures"),
        _status(severity).alias("status"),
    )


# -- failing rows -------------------------------------------------------------------

def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Values seen more than once (NULLs are not values here)."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1))


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def accepted_values_failures(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """Rows whose value is outside the list; NULL passes (not_null is the NULL check)."""
    return df.where(~F.col(column).isin(list(values)))


def relationships_failures(child: DataFrame, column: str, parent: DataFrame, field: str,
                           few_keys: bool = False) -> DataFrame:
    """Child rows whose key has no parent row; NULL child keys are not checked.

    A plain anti join: both sides are plain shuffles, so the adaptive skew join can split a hot child key, and
    the parent needs no ``distinct``. ``few_keys`` is for a parent that folds to few keys by its nature (LA
    codes): the distinct keys are then salted, 32 copies of that short list.
    """
    keys = parent.select(F.col(field).alias(column)).where(F.col(column).isNotNull())
    c = child.where(F.col(column).isNotNull())
    if few_keys:
        return lookup_join(c, keys.distinct(), column, "left_anti")
    return c.join(keys, column, "left_anti")


def range_failures(df: DataFrame, column: str, lo: float, hi: float) -> DataFrame:
    return df.where(~F.col(column).between(lo, hi))


# -- summaries ------------------------------------------------------------------------

def dq_unique(df: DataFrame, model: str, column: str, severity: str = "error") -> DataFrame:
    counted = unique_failures(df, column).agg(F.count(F.lit(1)).alias("failures"))
    return _summary(counted, model, "unique", severity, column)


def dq_not_null(df: DataFrame, model: str, columns: Sequence[str], severity: str = "error") -> DataFrame:
    """All columns of one table in one aggregate pass, then one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = counts.unpivot([], list(columns), "column_name", "failures")
    return _summary(long, model, "not_null", severity)


def dq_accepted_values(df: DataFrame, model: str, column: str, values: Sequence[str],
                       severity: str = "error") -> DataFrame:
    counted = df.agg(F.count_if(~F.col(column).isin(list(values))).alias("failures"))
    return _summary(counted, model, "accepted_values", severity, column)


def dq_relationships(child: DataFrame, model: str, column: str, parent: DataFrame, field: str,
                     severity: str = "warn", few_keys: bool = False) -> DataFrame:
    counted = relationships_failures(child, column, parent, field, few_keys).agg(F.count(F.lit(1)).alias("failures"))
    return _summary(counted, model, "relationships", severity, column)


def dq_range(df: DataFrame, model: str, column: str, lo: float, hi: float, severity: str = "warn") -> DataFrame:
    counted = df.agg(F.count_if(~F.col(column).between(lo, hi)).alias("failures"))
    return _summary(counted, model, "range", severity, column)


def dq_year_form(df: DataFrame, model: str, column: str = "academic_year", severity: str = "warn") -> DataFrame:
    """Years must be 4-digit start years (2022 for 2022/23): the period labels need that form.

    A value like 202324 would label as '202324/2325'. NULL passes (not_null covers it).
    """
    counted = df.agg(F.count_if(~F.col(column).between(1000, 9999)).alias("failures"))
    return _summary(counted, model, "year_form", severity, column)


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- the suite -------------------------------------------------------------------------

def unique_checks(t) -> DataFrame:
    """The five uniqueness checks. ``t`` maps model name -> DataFrame."""
    return _union([
        dq_unique(t["stg_gias"], "stg_gias", "urn"),
        dq_unique(t["stg_ks4"], "stg_ks4", "urn"),
        dq_unique(t["dim_school"], "dim_school", "urn"),
        dq_unique(t["fct_attendance_weekly"], "fct_attendance_weekly", "attendance_key"),
        dq_unique(t["fct_ks4_results"], "fct_ks4_results", "ks4_key"),
    ])


def not_null_checks(t) -> DataFrame:
    """The thirteen not-null checks, one pass per table."""
    return _union([
        dq_not_null(t["stg_gias"], "stg_gias", ["urn", "la_code"]),
        dq_not_null(t["stg_attendance"], "stg_attendance", ["la_code", "academic_year"]),
        dq_not_null(t["stg_ks4"], "stg_ks4", ["urn", "academic_year"]),
        dq_not_null(t["dim_school"], "dim_school", ["urn", "la_code", "is_secondary"]),
        dq_not_null(t["fct_attendance_weekly"], "fct_attendance_weekly", ["attendance_key", "la_code"]),
        dq_not_null(t["fct_ks4_results"], "fct_ks4_results", ["ks4_key", "urn"]),
    ])


def accepted_values_checks(t) -> DataFrame:
    return _union([
        dq_accepted_values(t["stg_gias"], "stg_gias", "phase", SCHOOL_PHASES),
        dq_accepted_values(t["stg_attendance"], "stg_attendance", "phase", ATTENDANCE_PHASES),
    ])


def relationship_checks(t) -> DataFrame:
    """The two warn-level referential checks into the dimension."""
    return _union([
        dq_relationships(t["fct_attendance_weekly"], "fct_attendance_weekly", "la_code", t["dim_school"], "la_code", few_keys=True),
        dq_relationships(t["fct_ks4_results"], "fct_ks4_results", "urn", t["dim_school"], "urn"),
    ])


def table_checks(df: DataFrame, model: str, unique: str | None = None, not_null: Sequence[str] = (),
                 accepted: dict | None = None, severity: str = "error") -> DataFrame:
    """Every unique / not-null / accepted-values check of one table in a single pass.

    With a uniqueness key, the not-null and accepted-values counters ride along in the
    same per-key aggregation (partial map-side, one shuffle on the key, which the
    uniqueness check needs anyway); a second tiny aggregation sums them. Without one,
    it is a single global aggregate. Output: one summary row per check.
    """
    accepted = accepted or {}
    checks = ([(f"nn{i}", c, "not_null", F.count_if(F.col(c).isNull())) for i, c in enumerate(not_null)]
              + [(f"av{i}", c, "accepted_values", F.count_if(~F.col(c).isin(list(v))))
                 for i, (c, v) in enumerate(accepted.items())])
    if unique:
        per_key = df.groupBy(unique).agg(F.count(F.lit(1)).alias("__n"), *[e.alias(k) for k, _, _, e in checks])
        totals = per_key.agg(
            F.count_if(F.col(unique).isNotNull() & (F.col("__n") > 1)).alias("uq"),
            *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k, _, _, _ in checks])
        checks = [("uq", unique, "unique", None)] + checks
    else:
        totals = df.agg(*[e.alias(k) for k, _, _, e in checks])
    bad = "warn" if severity == "warn" else "fail"
    rows = F.array(*[F.struct(
        F.lit(model).alias("model"), F.lit(c).alias("column_name"), F.lit(name).alias("check_name"),
        F.lit(severity).alias("severity"), F.col(k).cast("bigint").alias("failures"),
        F.when(F.col(k) == 0, "pass").otherwise(bad).alias("status")) for k, c, name, _ in checks])
    return totals.select(F.inline(rows))


def dq_summary(t) -> DataFrame:
    """All 22 checks as one frame: one pass per table, plus the two anti joins."""
    return _union([
        table_checks(t["stg_gias"], "stg_gias", "urn", ["urn", "la_code"], {"phase": SCHOOL_PHASES}),
        table_checks(t["stg_attendance"], "stg_attendance", None, ["la_code", "academic_year"],
                     {"phase": ATTENDANCE_PHASES}),
        table_checks(t["stg_ks4"], "stg_ks4", "urn", ["urn", "academic_year"]),
        table_checks(t["dim_school"], "dim_school", "urn", ["urn", "la_code", "is_secondary"]),
        table_checks(t["fct_attendance_weekly"], "fct_attendance_weekly", "attendance_key",
                     ["attendance_key", "la_code"]),
        table_checks(t["fct_ks4_results"], "fct_ks4_results", "ks4_key", ["ks4_key", "urn"]),
        relationship_checks(t),
    ])


# -- counts observed while a table is written -----------------------------------------

#: Checks of one row each, by table: columns never null, and accepted values.
ROW_CHECKS = {
    "stg_gias": (("urn", "la_code"), {"phase": SCHOOL_PHASES}),
    "stg_attendance": (("la_code", "academic_year"), {"phase": ATTENDANCE_PHASES}),
    "stg_ks4": (("urn", "academic_year"), {}),
    "dim_school": (("urn", "la_code", "is_secondary"), {}),
    "fct_attendance_weekly": (("attendance_key", "la_code"), {}),
    "fct_ks4_results": (("ks4_key", "urn"), {}),
}
METRICS_SCHEMA = "model string, check_name string, column_name string, failures long"


def row_counters(model: str) -> list[tuple[str, str, Column]]:
    """(check, column, counter of failing rows) of a table's row checks, and its rows under ``rows``."""
    not_null, accepted = ROW_CHECKS.get(model, ((), {}))
    return ([("rows", "*", F.count(F.lit(1)))]
            + [("not_null", c, F.count_if(F.col(c).isNull())) for c in not_null]
            + [("accepted_values", c, F.count_if(~F.col(c).isin(list(v)))) for c, v in accepted.items()])


def observed(df: DataFrame, model: str) -> tuple[DataFrame, Observation]:
    """``df`` with its row checks counted by whatever job runs it next. Put it where that job's last stage passes each
    row once: counters of a stage that is run again for lost shuffle files would count twice."""
    o = Observation(model)
    return df.observe(o, *[e.alias(f"{check}:{column}") for check, column, e in row_counters(model)]), o


def metric_rows(model: str, o: Observation) -> list[tuple[str, str, str, int]]:
    """The observed counts once the job has run: (model, check, column, failures)."""
    got = o.get
    return [(model, check, column, got[f"{check}:{column}"]) for check, column, _ in row_counters(model)]


def observed_summary(metrics: DataFrame, check: str, severity: str = "error") -> DataFrame:
    """One summary row for each observed check of a kind."""
    return metrics.where(F.col("check_name") == check).select(
        "model", "column_name", "check_name", F.lit(severity).alias("severity"), "failures", _status(severity).alias("status"))


def observed_suite(t, metrics: DataFrame) -> DataFrame:
    """All 22 checks where the row checks were counted by the writes: only keys are read, for uniqueness and relationships."""
    return _union([observed_summary(metrics, "not_null"), observed_summary(metrics, "accepted_values"), unique_checks(t), relationship_checks(t)])


class DataCheckError(RuntimeError):
    pass


def raise_on_error(summary: DataFrame) -> DataFrame:
    """Fail the build when an error-level check fails; warnings pass through.

    Collects the summary only: one row per check, a bounded, tiny result.
    """
    bad = [r.asDict() for r in summary.where(F.col("status") == "fail").collect()]
    if bad:
        raise DataCheckError(f"{len(bad)} error-level check(s) failed: {bad}")
    return summary
