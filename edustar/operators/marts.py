"""Mart tables: one conformed school dimension and two facts at two grains."""

from pyspark.sql import DataFrame

from edustar.functions import flag_secondary, surrogate_key


def dim_school(stg_gias: DataFrame) -> DataFrame:
    """Grain: open school; key ``urn``."""
    return stg_gias.select(
        "urn", "establishment_name", "phase",
        flag_secondary("phase").alias("is_secondary"),
        "la_code", "la_name", "region",
    )


def fct_attendance_weekly(stg_attendance: DataFrame) -> DataFrame:
    """Grain: LA x week x phase; key md5(la|year|week|phase)."""
    return stg_attendance.select(
        surrogate_key("la_code", "academic_year", "week_label", "phase").alias("attendance_key"),
        "la_code", "academic_year", "week_label", "phase", "possible_sessions",
        "pct_overall_absence", "pct_authorised_absence", "pct_unauthorised_absence", "pct_attendance",
    )


def fct_ks4_results(stg_ks4: DataFrame) -> DataFrame:
    """Grain: school x year; key md5(urn|year)."""
    return stg_ks4.select(
        surrogate_key("urn", "academic_year").alias("ks4_key"),
        "urn", "school_name", "la_name", "academic_year",
        "attainment8_score", "pct_grade5_eng_maths", "ebacc_aps",
    )


MART_BUILDERS = {
    "dim_school": ("stg_gias", dim_school),
    "fct_attendance_weekly": ("stg_attendance", fct_attendance_weekly),
    "fct_ks4_results": ("stg_ks4", fct_ks4_results),
}
