"""Name -> Spark query and name -> DuckDB oracle text, one entry per inventory id.

Every query takes ``(spark, sf_dir)``, builds (once per session and folder) the
landed raw tables and written marts from the driver tables under ``sf_dir``, and
returns a lazy DataFrame over them; nothing is collected here. Column names are
identical on both sides. Where ids name the same computation (an insight and the
sort that orders it), they share one function.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edustar.functions import pad_code, period_index, period_label, strict_int, suppressed_to_null, try_int
from edustar.functions import week_number, year_label
from edustar.operators import checks as C
from edustar.operators import insights as I
from edustar.operators import ranking as R
from edustar.operators import screen as S
from edustar.operators import staging as ST
from edustar.operators import views as V
from edustar.plans import oracle as O
from edustar.plans.pipeline import warehouse
from edustar.schema import ATTENDANCE_PHASES, NULL_TOKENS, REGISTER_COLUMNS, SCREEN_MESSAGES
from edustar.sources import files
from edustar.sources.fixtures import read_table
from edustar.sources.records import CutRecordError

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Parameters of the parameterised views (all present in every driver table size).
LA_NAME = "NATION_7"
SEARCH_REGEX = "customer#0+12"
ILIKE_TEXT = "ER#0000004"
REGIONS_PICKED = ("ASIA", "EUROPE")
YEARS_PICKED = ("1995/96", "1996/97")
LABEL_A = "Customer#000000001 — NATION_19"
LABEL_B = "Customer#000000002 — NATION_16"
MART_SQL = ("select la_name, count(*) as n_results, avg(attainment8_score) as avg_attainment8 "
            "from fct_ks4_results group by la_name")
CAPPED_SQL = ("select attendance_key, la_code, academic_year, week_label, phase, pct_overall_absence "
              "from fct_attendance_weekly order by attendance_key")


def register(names, oracle: str | None = None):
    names = [names] if isinstance(names, str) else list(names)

    def deco(fn: Query) -> Query:
        for n in names:
            QUERIES[n] = fn
            if oracle is not None:
                ORACLE[n] = oracle
        return fn
    return deco


def W(spark, sf_dir):
    return warehouse(spark, sf_dir)


def _tables(spark, sf_dir):
    return W(spark, sf_dir).tables()


def _own_folder(wh, name: str) -> str:
    """A folder for one call: a later call never changes what an earlier frame reads."""
    return f"{wh.root}/files/{uuid.uuid4().hex}/{name}"


def _enriched(spark, sf_dir):
    return W(spark, sf_dir).enriched


def _schools(spark, sf_dir):
    return W(spark, sf_dir).schools


# ===================================================================== 2.1 sources

#: What some values become before they are written as CSV: text with a line break, quotes and a delimiter.
BROKEN_SQL = "{c} || chr(10) || '\"annexe\", north'"


def _broken(column: str, every) -> Column:
    return F.when(every, F.concat(column, F.lit('\n"annexe", north'))).otherwise(F.col(column)).alias(column)


def _register_csv(wh, raw: DataFrame, leave_out=()) -> str:
    """The landed register as a CSV with the register's headers (Latin-1)."""
    back = {v: k for k, v in REGISTER_COLUMNS.items()}
    path = _own_folder(wh, "register_csv")
    files.write_csv(raw.select(*[F.col(c).alias(back[c]) for c in raw.columns if back[c] not in leave_out]), path, encoding="ISO-8859-1")
    return path


@register(["src_register_csv", "rename_map", "empty_to_null"], O.sql(
    "SELECT * REPLACE (CASE WHEN CAST(urn AS INTEGER) % 11 = 0 THEN " + BROKEN_SQL.format(c="establishment_name")
    + " ELSE establishment_name END AS establishment_name) FROM raw_gias"))
def q_src_register_csv(spark, sf_dir):
    """Landed register, some names with line breaks -> CSV (Latin-1, register headers) -> read back through the register reader."""
    wh = W(spark, sf_dir)
    raw = wh.raw("raw_gias")
    return files.read_register_csv(spark, _register_csv(wh, raw.withColumn("establishment_name", _broken(
        "establishment_name", F.col("urn").cast("int") % 11 == 0))))


@register("require_columns", O.sql(
    "SELECT 'whole' AS input, CAST(NULL AS VARCHAR) AS message, count(*) AS n_rows FROM raw_gias UNION ALL "
    "SELECT 'two columns less', " + O.q("input lacks the column(s) 'GOR (name)', 'LA (name)'") + ", CAST(NULL AS BIGINT)"))
def q_require_columns(spark, sf_dir):
    """The landed register as a CSV, whole and without two columns: what the reader says before any row is read."""
    wh = W(spark, sf_dir)
    out = []
    for name, leave_out in (("whole", ()), ("two columns less", ("GOR (name)", "LA (name)"))):
        path = _register_csv(wh, wh.raw("raw_gias"), leave_out)
        try:
            out.append(files.read_register_csv(spark, path).agg(F.lit(name).alias("input"), F.lit(None).cast("string").alias("message"),
                                                                F.count("*").alias("n_rows")))
        except ValueError as e:
            out.append(spark.range(1).select(F.lit(name).alias("input"), F.lit(str(e)).alias("message"), F.lit(None).cast("long").alias("n_rows")))
    return C._union(out)


@register("src_ees_csv", O.sql(
    "SELECT * REPLACE (CASE WHEN geographic_level = 'National' THEN " + BROKEN_SQL.format(c="school_type")
    + " ELSE school_type END AS school_type) FROM raw_attendance"))
def q_src_ees_csv(spark, sf_dir):
    """Landed attendance, national rows with a line break -> CSV (UTF-8) -> read back through the statistics reader."""
    wh = W(spark, sf_dir)
    path = _own_folder(wh, "attendance_csv")
    files.write_csv(wh.raw("raw_attendance").withColumn("school_type", _broken("school_type", F.col("geographic_level") == "National")), path)
    return files.read_ees_csv(spark, path)


#: A last record for a copy of the landed results, and whether it must stop the load.
DAMAGES = {"none": None, "short": '"2022","x"\n', "long": ",".join(['"1"'] * 60) + "\n", "cut": '"2022","never clo'}


@register("abort_on_malformed", O.sql(
    "SELECT 'none' AS damage, FALSE AS aborted, count(*) AS n_landed FROM raw_ks4 UNION ALL "
    "SELECT unnest(['short', 'long', 'cut']), TRUE, CAST(NULL AS BIGINT)"))
def q_abort_on_malformed(spark, sf_dir):
    """The landed results as a CSV, as they are and with one damaged record: whether landing them stops, and the rows landed."""
    wh = W(spark, sf_dir)
    out = []
    for name, record in DAMAGES.items():
        path = _own_folder(wh, "ks4_csv")
        files.write_csv(wh.raw("raw_ks4"), path)
        if record:
            head = ",".join(f'"{c}"' for c in wh.raw("raw_ks4").columns)
            spark.range(1).select(F.lit(f"{head}\n{record}")).coalesce(1).write.mode("append").option("lineSep", " ").text(path)
        try:
            n, aborted = files.land_raw(files.read_ees_csv(spark, path), _own_folder(wh, "landed")), False
        except (CutRecordError, PySparkException, Py4JJavaError):
            n, aborted = None, True
        out.append((name, aborted, n))
    return spark.createDataFrame(out, "damage string, aborted boolean, n_landed long")


@register("sanitise_headers", O.sql("SELECT * FROM raw_ks4"))
def q_sanitise_headers(spark, sf_dir):
    """Landed results -> CSV with display-style headers ('School Urn', ...) -> read back, headers sanitised."""
    wh = W(spark, sf_dir)
    path = _own_folder(wh, "ks4_csv")
    raw = wh.raw("raw_ks4")
    files.write_csv(raw.select(*[F.col(c).alias(c.replace("_", " ").title()) for c in raw.columns]), path)
    return files.read_ees_csv(spark, path)


@register("na_tokens_to_null", O.sql("SELECT * FROM raw_gias"))
def q_na_tokens_to_null(spark, sf_dir):
    """Landed register with its NULL regions spelled by the reader's NULL tokens in turn -> CSV -> read back as NULL."""
    wh = W(spark, sf_dir)
    token = F.get(F.array(*map(F.lit, NULL_TOKENS)), F.col("urn").cast("int") % len(NULL_TOKENS))
    return files.read_register_csv(spark, _register_csv(wh, wh.raw("raw_gias").withColumn("region_name", F.coalesce("region_name", token))))


@register(["land_raw", "raw_gias"], O.sql("SELECT * FROM raw_gias"))
def q_raw_gias(spark, sf_dir):
    return W(spark, sf_dir).raw("raw_gias")


@register("raw_attendance", O.sql("SELECT * FROM raw_attendance"))
def q_raw_attendance(spark, sf_dir):
    return W(spark, sf_dir).raw("raw_attendance")


@register(["raw_ks4", "src_raw_table"], O.sql("SELECT * FROM raw_ks4"))
def q_raw_ks4(spark, sf_dir):
    return W(spark, sf_dir).raw("raw_ks4")


@register("load_counts", O.sql(O.union([
    f"SELECT '{t}' AS table_name, count(*) AS n_rows FROM {t}" for t in ("raw_gias", "raw_attendance", "raw_ks4")])))
def q_load_counts(spark, sf_dir):
    return files.load_counts(W(spark, sf_dir).metrics)


_MART_COLUMNS = {
    "dim_school": {"urn": "", "establishment_name": "", "phase": "", "is_secondary": "", "la_code": "", "la_name": "", "region": ""},
    "fct_attendance_weekly": {
        "attendance_key": "", "la_code": "", "academic_year": "", "week_label": "", "phase": "", "possible_sessions": "",
        "pct_overall_absence": "double", "pct_authorised_absence": "double", "pct_unauthorised_absence": "double", "pct_attendance": "double"},
    "fct_ks4_results": {
        "ks4_key": "", "urn": "", "school_name": "", "la_name": "", "academic_year": "", "attainment8_score": "double",
        "pct_grade5_eng_maths": "double", "ebacc_aps": "double"},
}
_STAGING_COLUMNS = {
    "stg_gias": {"urn": "", "establishment_name": "", "phase": "", "la_code": "", "la_name": "", "region": "", "establishment_status": ""},
}


@register("export_marts", O.sql(O.union([O.digest_row(t, c) for t, c in _MART_COLUMNS.items()])))
def q_export_marts(spark, sf_dir):
    """The serving copy of the marts, published in a folder of its own: rows and content digest read back."""
    wh = W(spark, sf_dir)
    return files.export_marts({n: wh.mart(n) for n in wh.MARTS}, _own_folder(wh, "export"))


@register("materialise_table", O.sql(O.union([O.digest_row(t, c) for t, c in _MART_COLUMNS.items()])))
def q_materialise_table(spark, sf_dir):
    """The stored marts of the published version: rows and content digest."""
    wh = W(spark, sf_dir).refresh()
    return files.content_digests({n: wh.mart(n) for n in wh.MARTS})


@register("materialise_view", O.sql(O.union([O.digest_row(t, c) for t, c in _STAGING_COLUMNS.items()])))
def q_materialise_view(spark, sf_dir):
    """A staging view read by its name: rows and content digest."""
    W(spark, sf_dir).register_views()
    return files.content_digests({n: spark.table(n) for n in _STAGING_COLUMNS})


@register("mart_query", O.sql(MART_SQL))
def q_mart_query(spark, sf_dir):
    wh = W(spark, sf_dir)
    wh.register_views()
    return spark.sql(MART_SQL)


# ===================================================================== 2.14 composites

@register(["stg_gias", "select_rename"], O.sql("SELECT * FROM stg_gias"))
def q_stg_gias(spark, sf_dir):
    return W(spark, sf_dir).staging("stg_gias")


@register("stg_attendance", O.sql("SELECT * FROM stg_attendance"))
def q_stg_attendance(spark, sf_dir):
    return W(spark, sf_dir).staging("stg_attendance")


@register("stg_ks4", O.sql("SELECT * FROM stg_ks4"))
def q_stg_ks4(spark, sf_dir):
    return W(spark, sf_dir).staging("stg_ks4")


@register("dim_school", O.sql("SELECT * FROM dim_school"))
def q_dim_school(spark, sf_dir):
    return W(spark, sf_dir).dim


@register(["fct_attendance_weekly", "surrogate_attendance"], O.sql("SELECT * FROM fct_attendance_weekly"))
def q_fct_attendance(spark, sf_dir):
    return W(spark, sf_dir).attendance


@register(["fct_ks4_results", "surrogate_ks4"], O.sql("SELECT * FROM fct_ks4_results"))
def q_fct_ks4(spark, sf_dir):
    return W(spark, sf_dir).ks4


@register("attendance_enriched", O.sql("SELECT * FROM attendance_periods"))
def q_attendance_enriched(spark, sf_dir):
    return _enriched(spark, sf_dir)


@register(["schools_enriched", "join_ks4_region_by_name"], O.sql("SELECT * FROM schools"))
def q_schools_enriched(spark, sf_dir):
    return _schools(spark, sf_dir)


# ===================================================================== 2.2 projections

@register("strict_int_cast", O.sql(
    "SELECT school_urn, time_period, CAST(school_urn AS INTEGER) AS urn, CAST(time_period AS INTEGER) AS academic_year "
    "FROM raw_ks4"))
def q_strict_int_cast(spark, sf_dir):
    raw = W(spark, sf_dir).raw("raw_ks4")
    return raw.select("school_urn", "time_period", strict_int("school_urn").alias("urn"),
                      strict_int("time_period").alias("academic_year"))


@register("try_int_cast", O.sql(
    "SELECT time_period, time_identifier, geographic_level, old_la_code, school_type, possible_sessions, "
    "TRY_CAST(possible_sessions AS INTEGER) AS possible_sessions_int FROM raw_attendance"))
def q_try_int_cast(spark, sf_dir):
    raw = W(spark, sf_dir).raw("raw_attendance")
    return raw.select("time_period", "time_identifier", "geographic_level", "old_la_code", "school_type",
                      "possible_sessions", try_int("possible_sessions").alias("possible_sessions_int"))


_MEASURE_TEXT = ("overall_absence_perc", "authorised_absence_perc", "unauthorised_absence_perc", "attendance_perc")


@register("suppressed_to_null", O.sql(
    "SELECT time_period, time_identifier, geographic_level, old_la_code, school_type, "
    + ", ".join(f"{c}, {O.num(c)} AS {c}_value" for c in _MEASURE_TEXT) + " FROM raw_attendance"))
def q_suppressed_to_null(spark, sf_dir):
    raw = W(spark, sf_dir).raw("raw_attendance")
    cols = []
    for c in _MEASURE_TEXT:
        cols += [F.col(c), suppressed_to_null(c).alias(f"{c}_value")]
    return raw.select("time_period", "time_identifier", "geographic_level", "old_la_code", "school_type", *cols)


@register("pad_code", O.sql(
    "SELECT DISTINCT raw_code, lpad(raw_code, 3, '0') AS la_code FROM ("
    "SELECT la_code AS raw_code FROM raw_gias UNION ALL SELECT old_la_code FROM raw_attendance)"))
def q_pad_code(spark, sf_dir):
    wh = W(spark, sf_dir)
    codes = (wh.raw("raw_gias").select(F.col("la_code").alias("raw_code"))
             .unionByName(wh.raw("raw_attendance").select(F.col("old_la_code").alias("raw_code"))))
    return codes.select("raw_code", pad_code("raw_code").alias("la_code")).distinct()


@register("flag_secondary", O.sql("SELECT urn, phase, is_secondary FROM dim_school"))
def q_flag_secondary(spark, sf_dir):
    return W(spark, sf_dir).dim.select("urn", "phase", "is_secondary")


@register("label_unmapped", O.sql(
    "SELECT DISTINCT f.la_code, coalesce(r.region, '(unmapped)') AS region "
    "FROM fct_attendance_weekly f LEFT JOIN la_region r ON r.la_code = f.la_code"))
def q_label_unmapped(spark, sf_dir):
    wh = W(spark, sf_dir)
    j = wh.attendance.select("la_code").distinct().join(wh.la_region, "la_code", "left")
    return j.select("la_code", F.coalesce("region", F.lit("(unmapped)")).alias("region"))


@register("week_number", O.sql("SELECT DISTINCT week_label, week_num FROM attendance_periods"))
def q_week_number(spark, sf_dir):
    a = W(spark, sf_dir).attendance
    return a.select("week_label", week_number("week_label").alias("week_num")).distinct()


@register("year_label", O.sql("SELECT DISTINCT academic_year, year_label FROM attendance_periods"))
def q_year_label(spark, sf_dir):
    a = W(spark, sf_dir).attendance
    return a.select("academic_year", year_label("academic_year").alias("year_label")).distinct()


@register(["period_index", "period_label"], O.sql(
    "SELECT DISTINCT academic_year, week_label, period_idx, period_label FROM attendance_periods"))
def q_period(spark, sf_dir):
    a = W(spark, sf_dir).attendance
    return a.select("academic_year", "week_label", period_index("academic_year").alias("period_idx"),
                    period_label("academic_year").alias("period_label")).distinct()


# ===================================================================== 2.3 filters

@register("filter_open", O.sql(
    "SELECT * FROM raw_gias WHERE establishment_status IN ('Open', 'Open, but proposed to close')"))
def q_filter_open(spark, sf_dir):
    return ST.filter_open(W(spark, sf_dir).raw("raw_gias"))


@register("filter_la_rows", O.sql("SELECT * FROM raw_attendance WHERE geographic_level = 'Local authority'"))
def q_filter_la_rows(spark, sf_dir):
    return ST.filter_la_rows(W(spark, sf_dir).raw("raw_attendance"))


@register("filter_not_total", O.sql("SELECT * FROM raw_attendance WHERE school_type <> 'Total'"))
def q_filter_not_total(spark, sf_dir):
    return ST.filter_not_total(W(spark, sf_dir).raw("raw_attendance"))


@register("filter_min_sessions", O.sql(
    "SELECT * FROM raw_attendance WHERE TRY_CAST(possible_sessions AS INTEGER) >= 1000"))
def q_filter_min_sessions(spark, sf_dir):
    return ST.filter_min_sessions(W(spark, sf_dir).raw("raw_attendance"))


@register("session_guard_dropped", O.sql(
    "SELECT * FROM raw_attendance WHERE geographic_level = 'Local authority' AND school_type <> 'Total' "
    "AND coalesce(TRY_CAST(possible_sessions AS INTEGER) < 1000, true)"))
def q_session_guard_dropped(spark, sf_dir):
    return ST.session_guard_dropped(W(spark, sf_dir).raw("raw_attendance"))


@register("session_guard_under_threshold", O.sql(
    "SELECT * FROM raw_attendance WHERE geographic_level = 'Local authority' AND school_type <> 'Total' "
    "AND TRY_CAST(possible_sessions AS INTEGER) < 1000"))
def q_session_guard_under_threshold(spark, sf_dir):
    return ST.session_guard_under_threshold(W(spark, sf_dir).raw("raw_attendance"))


@register("filter_headline_rows", O.sql("SELECT * FROM raw_ks4 WHERE breakdown_topic = 'Total'"))
def q_filter_headline_rows(spark, sf_dir):
    return ST.filter_headline_rows(W(spark, sf_dir).raw("raw_ks4"))


@register("filter_phase", O.sql("SELECT * FROM fct_attendance_weekly WHERE phase = 'Secondary'"))
def q_filter_phase(spark, sf_dir):
    return W(spark, sf_dir).attendance.where(F.col("phase") == "Secondary")


@register("filter_secondary_flag", O.sql("SELECT * FROM dim_school WHERE is_secondary"))
def q_filter_secondary_flag(spark, sf_dir):
    return W(spark, sf_dir).dim.where(F.col("is_secondary"))


@register("filter_region_present", O.sql("SELECT * FROM dim_school WHERE region IS NOT NULL"))
def q_filter_region_present(spark, sf_dir):
    return W(spark, sf_dir).dim.where(F.col("region").isNotNull())


@register("filter_view", O.sql("SELECT * FROM default_view"))
def q_filter_view(spark, sf_dir):
    return V.filter_view(_enriched(spark, sf_dir), "Secondary")


@register("filter_view_selected", O.sql(
    f"SELECT * FROM attendance_periods WHERE phase = 'Primary' AND region IN {O.in_list(REGIONS_PICKED)} "
    f"AND year_label IN {O.in_list(YEARS_PICKED)}"))
def q_filter_view_selected(spark, sf_dir):
    return V.filter_view(_enriched(spark, sf_dir), "Primary", REGIONS_PICKED, YEARS_PICKED)


@register("search_name", O.sql(
    f"SELECT * FROM schools WHERE coalesce(regexp_matches(school_name, {O.q('(?i)' + SEARCH_REGEX)}), false)"))
def q_search_name(spark, sf_dir):
    return V.search_name(_schools(spark, sf_dir), SEARCH_REGEX)


@register("search_ilike", O.sql(f"SELECT * FROM fct_ks4_results WHERE school_name ILIKE {O.q('%' + ILIKE_TEXT + '%')}"))
def q_search_ilike(spark, sf_dir):
    return V.search_ilike(W(spark, sf_dir).ks4, ILIKE_TEXT)


@register("measure_present", O.sql("SELECT * FROM fct_ks4_results WHERE attainment8_score IS NOT NULL"))
def q_measure_present(spark, sf_dir):
    return V.measure_present(W(spark, sf_dir).ks4)


@register("filter_la_name", O.sql(f"SELECT * FROM fct_ks4_results WHERE la_name = {O.q(LA_NAME)}"))
def q_filter_la_name(spark, sf_dir):
    return V.filter_la_name(W(spark, sf_dir).ks4, LA_NAME)


# ===================================================================== 2.4 joins

@register("join_attendance_region", O.sql(
    "SELECT f.*, r.region FROM fct_attendance_weekly f LEFT JOIN la_region r ON r.la_code = f.la_code"))
def q_join_attendance_region(spark, sf_dir):
    wh = W(spark, sf_dir)
    return I.join_attendance_region(wh.attendance, wh.dim, wh.la_region)


@register("join_ks4_dim", O.sql(
    "SELECT f.urn, f.school_name, f.attainment8_score, d.la_code, d.phase, d.is_secondary "
    "FROM fct_ks4_results f JOIN dim_school d ON d.urn = f.urn"))
def q_join_ks4_dim(spark, sf_dir):
    wh = W(spark, sf_dir)
    f = wh.ks4.select("urn", "school_name", "attainment8_score")
    return f.join(wh.dim.select("urn", "la_code", "phase", "is_secondary"), "urn", "inner")


@register(["la_cross", "join_cross_fact"], O.sql("SELECT * FROM la_cross"))
def q_la_cross(spark, sf_dir):
    wh = W(spark, sf_dir)
    return I.la_cross(wh.attendance, wh.ks4, wh.dim)


@register("anti_attendance_la", O.sql(
    "SELECT * FROM fct_attendance_weekly f WHERE f.la_code IS NOT NULL AND NOT EXISTS "
    "(SELECT 1 FROM dim_school d WHERE d.la_code = f.la_code)"))
def q_anti_attendance_la(spark, sf_dir):
    wh = W(spark, sf_dir)
    return C.relationships_failures(wh.attendance, "la_code", wh.dim, "la_code", few_keys=True)


@register("anti_ks4_urn", O.sql(
    "SELECT * FROM fct_ks4_results f WHERE f.urn IS NOT NULL AND NOT EXISTS "
    "(SELECT 1 FROM dim_school d WHERE d.urn = f.urn)"))
def q_anti_ks4_urn(spark, sf_dir):
    wh = W(spark, sf_dir)
    return C.relationships_failures(wh.ks4, "urn", wh.dim, "urn")


_CMP_COLS = ("urn", "school_name", "la_name", "region", "attainment8_score", "pct_grade5_eng_maths", "ebacc_aps")


@register(["compare_schools", "measure_delta"], O.sql(
    "SELECT " + ", ".join([f"a.{c} AS a_{c}" for c in _CMP_COLS] + [f"b.{c} AS b_{c}" for c in _CMP_COLS]
                          + [f"b.{m} - a.{m} AS delta_{m}" for m in V.MEASURES])
    + " FROM pick_a a CROSS JOIN pick_b b",
    f"pick_a AS (SELECT * FROM labelled WHERE label = {O.q(LABEL_A)} ORDER BY urn NULLS LAST LIMIT 1),\n"
    f"pick_b AS (SELECT * FROM labelled WHERE label = {O.q(LABEL_B)} ORDER BY urn NULLS LAST LIMIT 1)"))
def q_compare_schools(spark, sf_dir):
    return V.compare_schools(_schools(spark, sf_dir), LABEL_A, LABEL_B)


# ===================================================================== 2.5 aggregations

@register("region_per_la", O.sql("SELECT * FROM la_region"))
def q_region_per_la(spark, sf_dir):
    return I.region_per_la(W(spark, sf_dir).dim)


@register("region_per_la_name", O.sql("SELECT * FROM la_region_by_name"))
def q_region_per_la_name(spark, sf_dir):
    return I.region_per_la_name(W(spark, sf_dir).dim)


@register("absence_by_la", O.sql("SELECT * FROM la_absence"))
def q_absence_by_la(spark, sf_dir):
    return I.absence_by_la(W(spark, sf_dir).attendance)


@register("attainment_by_la", O.sql("SELECT * FROM la_attainment"))
def q_attainment_by_la(spark, sf_dir):
    wh = W(spark, sf_dir)
    return I.attainment_by_la(wh.ks4, wh.dim)


@register(["insight_absence_by_region", "order_region_desc"], O.sql(
    "SELECT coalesce(r.region, '(unmapped)') AS region, round(avg(f.pct_overall_absence), 2) AS mean_secondary_absence, "
    "count(DISTINCT f.la_code) AS n_las FROM fct_attendance_weekly f LEFT JOIN la_region r ON r.la_code = f.la_code "
    "WHERE f.phase = 'Secondary' GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1"))
def q_insight_absence_by_region(spark, sf_dir):
    wh = W(spark, sf_dir)
    return I.insight_absence_by_region(wh.attendance, wh.dim, la_region=wh.la_region)


_QUARTILE_CTE = ("quartiled AS (SELECT la_code, avg_secondary_absence, avg_attainment8, "
                 "CAST(ntile(4) OVER (ORDER BY avg_secondary_absence ASC NULLS LAST, la_code) AS INTEGER) "
                 "AS absence_quartile FROM la_joined)")


@register("absence_quartile", O.sql("SELECT * FROM quartiled", _QUARTILE_CTE))
def q_absence_quartile(spark, sf_dir):
    wh = W(spark, sf_dir)
    return I.absence_quartile(I.la_joined(wh.attendance, wh.ks4, wh.dim))


@register(["insight_absence_quartiles", "order_quartile"], O.sql(
    "SELECT absence_quartile, round(avg(avg_secondary_absence), 2) AS mean_absence_pct, "
    "round(avg(avg_attainment8), 2) AS mean_attainment8, count(*) AS n_las FROM quartiled "
    "GROUP BY absence_quartile ORDER BY absence_quartile", _QUARTILE_CTE))
def q_insight_absence_quartiles(spark, sf_dir):
    wh = W(spark, sf_dir)
    return I.insight_absence_quartiles(wh.attendance, wh.ks4, wh.dim)


_PAIRS = "pairs AS (SELECT * FROM la_cross WHERE avg_absence IS NOT NULL AND avg_attainment8 IS NOT NULL)"
_VARIES = ("count(*) >= 2 AND min(avg_absence) < max(avg_absence) "
           "AND min(avg_attainment8) < max(avg_attainment8)")


@register("corr_absence_attainment", O.sql(
    f"SELECT round(CASE WHEN {_VARIES} THEN corr(avg_attainment8, avg_absence) END, 6) AS corr, "
    "count(*) AS n_las FROM pairs", _PAIRS))
def q_corr(spark, sf_dir):
    wh = W(spark, sf_dir)
    return I.corr_absence_attainment(I.la_cross(wh.attendance, wh.ks4, wh.dim))


@register("trendline", O.sql(
    f"SELECT round(CASE WHEN {_VARIES} THEN regr_slope(avg_attainment8, avg_absence) END, 6) AS slope, "
    f"round(CASE WHEN {_VARIES} THEN regr_intercept(avg_attainment8, avg_absence) END, 6) AS intercept, "
    "count(*) AS n_las FROM pairs", _PAIRS))
def q_trendline(spark, sf_dir):
    wh = W(spark, sf_dir)
    return I.trendline(I.la_cross(wh.attendance, wh.ks4, wh.dim))


@register(["absence_trend", "order_trend"], O.sql(
    "SELECT period_idx, period_label, region, avg(pct_overall_absence) AS mean_absence FROM default_view "
    "GROUP BY 1, 2, 3 ORDER BY period_idx, region"))
def q_absence_trend(spark, sf_dir):
    return V.absence_trend(V.filter_view(W(spark, sf_dir).attendance_view("region", "academic_year", "week_label", "phase"), "Secondary"))


@register(["absence_rank", "order_rank"], O.sql(
    "SELECT region, avg(pct_overall_absence) AS mean_absence FROM default_view GROUP BY region "
    "ORDER BY mean_absence DESC NULLS LAST, region"))
def q_absence_rank(spark, sf_dir):
    return V.absence_rank(V.filter_view(W(spark, sf_dir).attendance_view("region", "academic_year", "phase"), "Secondary"))


@register("attendance_headline", O.sql(
    "SELECT avg(pct_overall_absence) AS mean_absence, count(DISTINCT region) AS n_regions, "
    "count(DISTINCT period_idx) AS n_periods FROM default_view"))
def q_attendance_headline(spark, sf_dir):
    return V.attendance_headline(V.filter_view(W(spark, sf_dir).attendance_view("region", "academic_year", "week_label", "phase"), "Secondary"))


@register("school_headline", O.sql(
    "SELECT count(*) AS n_schools, avg(attainment8_score) AS mean_attainment8 FROM schools "
    f"WHERE coalesce(regexp_matches(school_name, {O.q('(?i)' + SEARCH_REGEX)}), false)"))
def q_school_headline(spark, sf_dir):
    return V.school_headline(V.search_name(_schools(spark, sf_dir), SEARCH_REGEX))


@register("national_absence", O.sql(
    "SELECT round(avg(pct_overall_absence), 2) AS national_absence FROM fct_attendance_weekly WHERE phase = 'Secondary'"))
def q_national_absence(spark, sf_dir):
    return I.national_absence(W(spark, sf_dir).attendance)


@register("attainment_spread", O.sql(
    "SELECT round(min(avg_attainment8), 2) AS min_attainment8, round(max(avg_attainment8), 2) AS max_attainment8 "
    "FROM la_attainment"))
def q_attainment_spread(spark, sf_dir):
    wh = W(spark, sf_dir)
    return I.attainment_spread(wh.ks4, wh.dim)


@register("filter_options", O.sql(
    "SELECT DISTINCT * FROM (SELECT 'region' AS kind, region AS value FROM attendance_periods "
    "WHERE region <> '(unmapped)' UNION ALL SELECT 'year', year_label FROM attendance_periods "
    "UNION ALL SELECT 'phase', phase FROM attendance_periods) ORDER BY kind, value"))
def q_filter_options(spark, sf_dir):
    return V.filter_options(W(spark, sf_dir).attendance_view("region", "academic_year", "phase"))


@register(["school_labels", "school_label"], O.sql("SELECT DISTINCT label FROM labelled ORDER BY label"))
def q_school_labels(spark, sf_dir):
    return V.school_labels(_schools(spark, sf_dir))


# ===================================================================== 2.7 sorts, limits, top-k

_DISPLAY = ("school_name AS \"School\", la_name AS \"LA\", region AS \"Region\", attainment8_score AS \"Attainment 8\", "
            "pct_grade5_eng_maths AS \"% grade 5+ E&M\", ebacc_aps AS \"EBacc APS\"")


@register("schools_by_score", O.sql(
    f"SELECT {_DISPLAY} FROM schools ORDER BY attainment8_score DESC NULLS LAST, urn"))
def q_schools_by_score(spark, sf_dir):
    return V.schools_by_score(_schools(spark, sf_dir))


@register("top_k_schools", O.sql(
    f"SELECT urn, school_name, la_name, attainment8_score FROM fct_ks4_results WHERE la_name = {O.q(LA_NAME)} "
    "AND attainment8_score IS NOT NULL ORDER BY attainment8_score DESC, urn LIMIT 5"))
def q_top_k_schools(spark, sf_dir):
    return V.top_k_schools(W(spark, sf_dir).ks4, LA_NAME)


@register("auto_limit", O.sql(CAPPED_SQL + "\nlimit 1000"))
def q_auto_limit(spark, sf_dir):
    wh = W(spark, sf_dir)
    wh.register_views()
    return S.auto_limit(spark.sql(CAPPED_SQL), CAPPED_SQL)


@register("first_match", O.sql(
    f"SELECT urn, school_name, la_name, region, attainment8_score, pct_grade5_eng_maths, ebacc_aps FROM labelled "
    f"WHERE label = {O.q(LABEL_A)} ORDER BY urn NULLS LAST LIMIT 1"))
def q_first_match(spark, sf_dir):
    return V.first_match(_schools(spark, sf_dir), LABEL_A)


# ===================================================================== 2.12 data checks

@register("dq_unique", O.sql(O.union(O.UNIQUE_CHECKS)))
def q_dq_unique(spark, sf_dir):
    return C.unique_checks(_tables(spark, sf_dir))


@register("dq_not_null", O.sql(O.union(O.NOT_NULL_CHECKS)))
def q_dq_not_null(spark, sf_dir):
    """Counted by the jobs that wrote the tables."""
    return C.observed_summary(W(spark, sf_dir).metrics, "not_null")


@register("dq_accepted_values", O.sql(O.union(O.ACCEPTED_CHECKS)))
def q_dq_accepted_values(spark, sf_dir):
    """Counted by the jobs that wrote the tables."""
    return C.observed_summary(W(spark, sf_dir).metrics, "accepted_values")


@register("dq_severity", O.sql(O.union([
    O.check_row("raw_ks4", "school_urn", "unique", "error",
                "SELECT count(*) FROM (SELECT school_urn FROM raw_ks4 WHERE school_urn IS NOT NULL GROUP BY school_urn HAVING count(*) > 1)"),
    O.check_row("raw_gias", "region_name", "not_null", "warn", "SELECT count(*) FROM raw_gias WHERE region_name IS NULL"),
    O.check_row("raw_attendance", "school_type", "accepted_values", "error",
                f"SELECT count(*) FROM raw_attendance WHERE school_type NOT IN {O.in_list(ATTENDANCE_PHASES)}"),
    O.check_row("raw_attendance", "geographic_level", "accepted_values", "error",
                "SELECT count(*) FROM raw_attendance WHERE geographic_level NOT IN ('National', 'Regional', 'Local authority')")])))
def q_dq_severity(spark, sf_dir):
    """The check kinds on landed tables, which staging has not cleaned yet: the same failures stop a build or only warn."""
    wh = W(spark, sf_dir)
    return C._union([
        C.dq_unique(wh.raw("raw_ks4"), "raw_ks4", "school_urn"),
        C.dq_not_null(wh.raw("raw_gias"), "raw_gias", ["region_name"], "warn"),
        C.dq_accepted_values(wh.raw("raw_attendance"), "raw_attendance", "school_type", ATTENDANCE_PHASES),
        C.dq_accepted_values(wh.raw("raw_attendance"), "raw_attendance", "geographic_level", ("National", "Regional", "Local authority"))])


@register("school_quartile", O.sql(
    "SELECT ks4_key, attainment8_score, CAST(ntile(4) OVER (ORDER BY attainment8_score NULLS LAST, ks4_key) AS INTEGER) AS quartile FROM fct_ks4_results"))
def q_school_quartile(spark, sf_dir):
    """Quartile of every school result by score: tiles by range partitions, no single-partition window over the rows."""
    return R.ntile(W(spark, sf_dir).ks4.select("ks4_key", "attainment8_score"), 4, [F.asc_nulls_last("attainment8_score"), F.asc("ks4_key")], "quartile")


@register("dq_relationships", O.sql(O.union(O.RELATIONSHIP_CHECKS)))
def q_dq_relationships(spark, sf_dir):
    return C.relationship_checks(_tables(spark, sf_dir))


@register("dq_range", O.sql(O.check_row(
    "fct_ks4_results", "attainment8_score", "range", "warn",
    "SELECT count(*) FROM fct_ks4_results WHERE NOT (attainment8_score BETWEEN 0 AND 90)")))
def q_dq_range(spark, sf_dir):
    return C.dq_range(W(spark, sf_dir).ks4, "fct_ks4_results", "attainment8_score", 0, 90)


@register("dq_year_form", O.sql(O.union([O.check_row(
    m, "academic_year", "year_form", "warn", f"SELECT count(*) FROM {m} WHERE NOT (academic_year BETWEEN 1000 AND 9999)")
    for m in ("fct_attendance_weekly", "fct_ks4_results")])))
def q_dq_year_form(spark, sf_dir):
    wh = W(spark, sf_dir)
    return C._union([C.dq_year_form(wh.attendance, "fct_attendance_weekly"), C.dq_year_form(wh.ks4, "fct_ks4_results")])


@register("dq_summary", O.sql(O.union(O.UNIQUE_CHECKS + O.NOT_NULL_CHECKS + O.ACCEPTED_CHECKS + O.RELATIONSHIP_CHECKS)))
def q_dq_summary(spark, sf_dir):
    return W(spark, sf_dir).checked()


# ===================================================================== 2.13 query screen

def _screened(spark, sf_dir):
    return S.screen_queries(S.conversation_queries(read_table(spark, sf_dir, "conversations")))


_MESSAGE_CASE = "CASE rule " + " ".join(f"WHEN {O.q(k)} THEN {O.q(v)}" for k, v in SCREEN_MESSAGES.items()) + " END"


@register("screen_queries", O.sql(
    f"SELECT conv_id, turn, rule, {_MESSAGE_CASE} AS message, rule = 'ok' AS ok, "
    "CASE WHEN rule = 'ok' THEN CASE WHEN has_limit THEN sql ELSE sql || chr(10) || 'limit 1000' END END AS sql_limited "
    "FROM verdicts", O.SCREEN_CTES))
def q_screen_queries(spark, sf_dir):
    return _screened(spark, sf_dir).select("conv_id", "turn", "rule", "message", "ok", "sql_limited")


@register(["screen_rules", "screen_select_only", "screen_single_statement", "screen_keywords", "screen_schemas",
           "screen_limit"], O.sql(
    "SELECT conv_id, turn, role, select_only, single_statement, no_keywords, no_schemas, has_limit, "
    "CASE WHEN has_limit THEN sql ELSE sql || chr(10) || 'limit 1000' END AS sql_capped FROM rules",
    O.SCREEN_CTES))
def q_screen_rules(spark, sf_dir):
    t = S.conversation_queries(read_table(spark, sf_dir, "conversations"))
    return t.select("conv_id", "turn", "role", S.screen_limit("sql").alias("sql_capped"),
                    S.screen_select_only("sql").alias("select_only"),
                    S.screen_single_statement("sql").alias("single_statement"),
                    S.screen_keywords("sql").alias("no_keywords"),
                    S.screen_schemas("sql").alias("no_schemas"),
                    S.has_limit("sql").alias("has_limit"))


@register("clean_answer", O.sql("SELECT conv_id, turn, role, sql FROM texts", O.SCREEN_CTES))
def q_clean_answer(spark, sf_dir):
    return S.conversation_queries(read_table(spark, sf_dir, "conversations")).select("conv_id", "turn", "role", "sql")


@register("screen_verdict_counts", O.sql(
    f"SELECT rule, {_MESSAGE_CASE} AS message, count(*) AS n_queries FROM verdicts GROUP BY rule", O.SCREEN_CTES))
def q_screen_verdict_counts(spark, sf_dir):
    return S.screen_verdict_counts(_screened(spark, sf_dir))


@register("run_screened", O.sql(MART_SQL + "\nlimit 1000"))
def q_run_screened(spark, sf_dir):
    wh = W(spark, sf_dir)
    return S.run_screened(spark, MART_SQL, {n: wh.mart_path(n) for n in wh.MARTS})


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
