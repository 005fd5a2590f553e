"""Staging views: rename, cast and filter each raw table (one view per source).

Each function is lazy; Catalyst inlines it into whatever reads it, so the filters
below reach the Parquet scan of the landed raw table (``PushedFilters``) and only the
named columns are read (``ReadSchema``).
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edustar.functions import pad_code, strict_int, suppressed_to_null, try_int
from edustar.schema import HEADLINE_BREAKDOWN, LA_LEVEL, MIN_SESSIONS, OPEN_STATUSES, TOTAL_PHASE


# -- filters (each usable on its own) -----------------------------------------

def filter_open(raw_gias: DataFrame) -> DataFrame:
    """Register rows of currently open schools (two statuses)."""
    return raw_gias.where(F.col("establishment_status").isin(*OPEN_STATUSES))


def filter_la_rows(raw_attendance: DataFrame) -> DataFrame:
    """Attendance rows at local-authority level."""
    return raw_attendance.where(F.col("geographic_level") == LA_LEVEL)


def filter_not_total(raw_attendance: DataFrame) -> DataFrame:
    """Drops the all-phase row; a NULL school type drops too."""
    return raw_attendance.where(F.col("school_type") != TOTAL_PHASE)


def filter_min_sessions(raw_attendance: DataFrame, threshold: int = MIN_SESSIONS) -> DataFrame:
    """Drops near-empty weeks; suppressed or missing session counts drop too."""
    return raw_attendance.where(try_int("possible_sessions") >= threshold)


def filter_headline_rows(raw_ks4: DataFrame) -> DataFrame:
    """All-pupils result rows only, so each school appears once per year."""
    return raw_ks4.where(F.col("breakdown_topic") == HEADLINE_BREAKDOWN)


# -- views --------------------------------------------------------------------

def stg_gias(raw_gias: DataFrame) -> DataFrame:
    return filter_open(raw_gias).select(
        strict_int("urn").alias("urn"),
        F.col("establishment_name"),
        F.col("phase_name").alias("phase"),
        pad_code("la_code").alias("la_code"),
        F.col("la_name"),
        F.col("region_name").alias("region"),
        F.col("establishment_status"),
    )


def stg_attendance(raw_attendance: DataFrame, min_sessions: int = MIN_SESSIONS) -> DataFrame:
    df = filter_min_sessions(filter_not_total(filter_la_rows(raw_attendance)), min_sessions)
    return df.select(
        strict_int("time_period").alias("academic_year"),
        F.col("time_identifier").alias("week_label"),
        pad_code("old_la_code").alias("la_code"),
        F.col("la_name"),
        F.col("school_type").alias("phase"),
        try_int("possible_sessions").alias("possible_sessions"),
        suppressed_to_null("overall_absence_perc").alias("pct_overall_absence"),
        suppressed_to_null("authorised_absence_perc").alias("pct_authorised_absence"),
        suppressed_to_null("unauthorised_absence_perc").alias("pct_unauthorised_absence"),
        suppressed_to_null("attendance_perc").alias("pct_attendance"),
    )


def stg_ks4(raw_ks4: DataFrame) -> DataFrame:
    return filter_headline_rows(raw_ks4).select(
        strict_int("school_urn").alias("urn"),
        F.col("school_name"),
        F.col("la_name"),
        strict_int("time_period").alias("academic_year"),
        suppressed_to_null("attainment8_average").alias("attainment8_score"),
        suppressed_to_null("gcse_five_engmath_percent").alias("pct_grade5_eng_maths"),
        suppressed_to_null("ebacc_aps_average").alias("ebacc_aps"),
    )


def session_guard_dropped(raw_attendance: DataFrame, threshold: int = MIN_SESSIONS) -> DataFrame:
    """LA rows (Total dropped) that the session guard removes: under the threshold or unparsable."""
    df = filter_not_total(filter_la_rows(raw_attendance))
    return df.where(F.coalesce(try_int("possible_sessions") < threshold, F.lit(True)))


def session_guard_under_threshold(raw_attendance: DataFrame, threshold: int = MIN_SESSIONS) -> DataFrame:
    """LA rows (Total dropped) with a session count under the threshold; suppressed counts not included."""
    df = filter_not_total(filter_la_rows(raw_attendance))
    return df.where(try_int("possible_sessions") < threshold)
