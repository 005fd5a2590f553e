"""DuckDB text for the correctness oracle.

Written from the mapping and model rules, not from the DataFrame code. The driver
tables are pre-registered views; every oracle query starts with ``WITH`` and the
CTE chain raw -> staging -> marts below, then its own CTEs and final SELECT.

Dialect notes: ``//`` is integer division; ``trunc`` before a BIGINT cast because
DuckDB rounds where Spark truncates; NULL order is always written out.
"""

from edustar.schema import (
    ATTENDANCE_PHASES, FORBIDDEN_SCHEMAS, FORBIDDEN_WORDS, NUMERIC_PATTERN, SCHOOL_PHASES, SPACE_CLASS,
    WORD_CHAR,
)


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def num(col: str) -> str:
    """Suppressed text -> DOUBLE, only for text shaped like a number."""
    return f"CASE WHEN regexp_full_match({col}, {q(NUMERIC_PATTERN)}) THEN TRY_CAST({col} AS DOUBLE) END"


def digest_row(table: str, columns: dict[str, str]) -> str:
    """Rows and content digest of a table: columns by name, doubles with six decimals, 60 bits of the MD5 of each row summed."""
    def text(c: str) -> str:
        value = f"CAST(CAST({c} AS DECIMAL(30,6)) AS VARCHAR)" if columns[c] == "double" else f"CAST({c} AS VARCHAR)"
        return f"coalesce(length({value}) || ':' || {value}, '-')"
    row = " || ".join(text(c) for c in sorted(columns))
    return (f"SELECT {q(table)} AS table_name, count(*) AS n_rows, "
            f"CAST(coalesce(sum(CAST('0x' || substr(md5({row}), 1, 15) AS HUGEINT)), 0) AS VARCHAR) AS digest FROM {table}")


RAW = f"""
raw_gias AS (
  SELECT CAST(c.c_custkey + 100000 AS VARCHAR) AS urn,
         c.c_name AS establishment_name,
         CASE c.c_custkey % 10 WHEN 1 THEN 'Primary' WHEN 2 THEN 'All-through' WHEN 3 THEN 'Nursery'
              WHEN 4 THEN '16 plus' WHEN 5 THEN 'Middle deemed secondary' WHEN 6 THEN 'Middle deemed primary'
              WHEN 7 THEN 'Not applicable' ELSE 'Secondary' END AS phase_name,
         CAST(c.c_nationkey AS VARCHAR) AS la_code,
         n.n_name AS la_name,
         CASE WHEN c.c_nationkey = 24 THEN 'Closed'
              WHEN c.c_mktsegment = 'AUTOMOBILE' THEN 'Closed'
              WHEN c.c_mktsegment = 'FURNITURE' THEN 'Proposed to open'
              WHEN c.c_mktsegment = 'BUILDING' THEN 'Open, but proposed to close'
              ELSE 'Open' END AS establishment_status,
         CASE WHEN c.c_custkey % 7 = 0 THEN NULL ELSE r.r_name END AS region_name
  FROM customer c
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
att_cells AS (
  SELECT c.c_nationkey AS la, n.n_name, r.r_name,
         year(l.l_shipdate) AS y, weekofyear(l.l_shipdate) AS w,
         CASE l.l_returnflag WHEN 'A' THEN 'Primary' WHEN 'N' THEN 'Secondary' WHEN 'R' THEN 'Special' END AS st,
         sum(CAST(trunc(l.l_quantity) AS BIGINT)) AS q,
         sum(CAST(round(l.l_discount * 100) AS BIGINT)) AS d,
         sum(CAST(round(l.l_tax * 100) AS BIGINT)) AS t,
         count(*) AS n
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY 1, 2, 3, 4, 5, 6
),
att_levels AS (
  SELECT 'Local authority' AS geographic_level, la, n_name, y, w, st, q, d, t, n FROM att_cells
  UNION ALL
  SELECT 'Local authority', la, n_name, y, w, 'Total', sum(q), sum(d), sum(t), sum(n)
  FROM att_cells GROUP BY la, n_name, y, w
  UNION ALL
  SELECT 'Regional', NULL, NULL, y, w, st, sum(q), sum(d), sum(t), sum(n)
  FROM att_cells GROUP BY r_name, y, w, st
  UNION ALL
  SELECT 'National', NULL, NULL, y, w, st, sum(q), sum(d), sum(t), sum(n)
  FROM att_cells GROUP BY y, w, st
),
raw_attendance AS (
  SELECT CAST(y AS VARCHAR) AS time_period,
         'Week ' || CAST(w AS VARCHAR) AS time_identifier,
         geographic_level,
         CAST(la AS VARCHAR) AS old_la_code,
         'E09' || lpad(CAST(la AS VARCHAR), 6, '0') AS new_la_code,
         n_name AS la_name,
         st AS school_type,
         CASE WHEN (la + w + y) % 29 = 0 THEN 'z' ELSE CAST(q * 40 AS VARCHAR) END AS possible_sessions,
         CASE WHEN (la * 7 + w) % 23 = 0 OR (la = 23 AND st = 'Secondary') THEN 'c'
              ELSE CAST((d * 10) // n AS VARCHAR) || '.0' END AS overall_absence_perc,
         CASE WHEN (la * 5 + w) % 19 = 0 THEN 'x' ELSE CAST((d * 6) // n AS VARCHAR) || '.0' END AS authorised_absence_perc,
         CASE WHEN (la * 3 + w) % 17 = 0 THEN 'low' ELSE CAST((t * 4) // n AS VARCHAR) || '.0' END AS unauthorised_absence_perc,
         CAST(100 - (d * 10) // n AS VARCHAR) || '.0' AS attendance_perc
  FROM att_levels
),
ks4_cells AS (
  SELECT o_custkey, o_orderpriority, count(*) AS n,
         sum(CAST(floor(o_totalprice) AS BIGINT)) AS s,
         count(*) FILTER (WHERE o_orderstatus = 'F') AS f
  FROM orders GROUP BY 1, 2
),
ks4_levels AS (
  SELECT o_custkey, 'Priority' AS breakdown_topic, o_orderpriority AS breakdown, n, s, f FROM ks4_cells
  UNION ALL
  SELECT o_custkey, 'Total', 'Total', sum(n), sum(s), sum(f) FROM ks4_cells GROUP BY o_custkey
),
raw_ks4 AS (
  SELECT CAST(k.o_custkey + 100000 AS VARCHAR) AS school_urn,
         c.c_name AS school_name,
         nn.n_name AS la_name,
         '2000' AS time_period,
         k.breakdown_topic, k.breakdown,
         CASE WHEN k.n < 4 THEN 'c' ELSE CAST(k.s // (k.n * 5000) AS VARCHAR) || '.0' END AS attainment8_average,
         CASE WHEN k.n < 4 THEN 'c' ELSE CAST((k.f * 100) // k.n AS VARCHAR) || '.0' END AS gcse_five_engmath_percent,
         CASE WHEN k.n < 6 THEN 'z' ELSE CAST(k.s // (k.n * 50000) AS VARCHAR) || '.0' END AS ebacc_aps_average
  FROM ks4_levels k
  JOIN customer c ON c.c_custkey = k.o_custkey
  JOIN nation nn ON nn.n_nationkey = c.c_nationkey
)"""

STAGING = f"""
stg_gias AS (
  SELECT CAST(urn AS INTEGER) AS urn, establishment_name, phase_name AS phase,
         lpad(la_code, 3, '0') AS la_code, la_name, region_name AS region, establishment_status
  FROM raw_gias
  WHERE establishment_status IN ('Open', 'Open, but proposed to close')
),
stg_attendance AS (
  SELECT CAST(time_period AS INTEGER) AS academic_year,
         time_identifier AS week_label,
         lpad(old_la_code, 3, '0') AS la_code,
         la_name,
         school_type AS phase,
         TRY_CAST(possible_sessions AS INTEGER) AS possible_sessions,
         {num('overall_absence_perc')} AS pct_overall_absence,
         {num('authorised_absence_perc')} AS pct_authorised_absence,
         {num('unauthorised_absence_perc')} AS pct_unauthorised_absence,
         {num('attendance_perc')} AS pct_attendance
  FROM raw_attendance
  WHERE geographic_level = 'Local authority'
    AND school_type <> 'Total'
    AND TRY_CAST(possible_sessions AS INTEGER) >= 1000
),
stg_ks4 AS (
  SELECT CAST(school_urn AS INTEGER) AS urn, school_name, la_name,
         CAST(time_period AS INTEGER) AS academic_year,
         {num('attainment8_average')} AS attainment8_score,
         {num('gcse_five_engmath_percent')} AS pct_grade5_eng_maths,
         {num('ebacc_aps_average')} AS ebacc_aps
  FROM raw_ks4
  WHERE breakdown_topic = 'Total'
)"""

MARTS = """
dim_school AS (
  SELECT urn, establishment_name, phase, phase IN ('Secondary', 'All-through') AS is_secondary,
         la_code, la_name, region
  FROM stg_gias
),
fct_attendance_weekly AS (
  SELECT md5(la_code || '|' || CAST(academic_year AS VARCHAR) || '|' || week_label || '|' || phase) AS attendance_key,
         la_code, academic_year, week_label, phase, possible_sessions,
         pct_overall_absence, pct_authorised_absence, pct_unauthorised_absence, pct_attendance
  FROM stg_attendance
),
fct_ks4_results AS (
  SELECT md5(CAST(urn AS VARCHAR) || '|' || CAST(academic_year AS VARCHAR)) AS ks4_key,
         urn, school_name, la_name, academic_year, attainment8_score, pct_grade5_eng_maths, ebacc_aps
  FROM stg_ks4
)"""

# Shared analytic CTEs.
SHARED = """
la_region AS (
  SELECT la_code, max(region) AS region FROM dim_school GROUP BY la_code
),
la_region_by_name AS (
  SELECT la_name, max(region) AS region FROM dim_school WHERE region IS NOT NULL GROUP BY la_name
),
la_absence AS (
  SELECT la_code, avg(pct_overall_absence) AS avg_secondary_absence
  FROM fct_attendance_weekly WHERE phase = 'Secondary' GROUP BY la_code
),
la_attainment AS (
  SELECT d.la_code, max(d.la_name) AS la_name, avg(f.attainment8_score) AS avg_attainment8
  FROM fct_ks4_results f JOIN dim_school d ON d.urn = f.urn
  WHERE d.is_secondary GROUP BY d.la_code
),
la_joined AS (
  SELECT a.la_code, a.avg_secondary_absence, t.avg_attainment8
  FROM la_absence a JOIN la_attainment t ON a.la_code = t.la_code
),
la_cross AS (
  SELECT a.la_code, t.la_name, a.avg_secondary_absence AS avg_absence, t.avg_attainment8
  FROM la_absence a JOIN la_attainment t ON a.la_code = t.la_code
),
attendance_enriched AS (
  SELECT f.academic_year, f.week_label, coalesce(r.region, '(unmapped)') AS region, f.phase,
         f.pct_overall_absence,
         TRY_CAST(regexp_extract(f.week_label, '(\\d+)', 1) AS INTEGER) AS week_num,
         CAST(f.academic_year AS VARCHAR) || '/' || substr(CAST(f.academic_year + 1 AS VARCHAR), 3) AS year_label
  FROM fct_attendance_weekly f LEFT JOIN la_region r ON r.la_code = f.la_code
),
attendance_periods AS (
  SELECT academic_year, week_label, region, phase, pct_overall_absence, week_num, year_label,
         academic_year * 100 + coalesce(week_num, 0) AS period_idx,
         year_label || ' W' || printf('%02d', coalesce(week_num, 0)) AS period_label
  FROM attendance_enriched
),
default_view AS (
  SELECT * FROM attendance_periods WHERE phase = 'Secondary' AND region <> '(unmapped)'
),
schools AS (
  SELECT f.urn, f.school_name, f.la_name, lr.region, f.attainment8_score, f.pct_grade5_eng_maths, f.ebacc_aps
  FROM fct_ks4_results f LEFT JOIN la_region_by_name lr ON lr.la_name = f.la_name
),
labelled AS (
  SELECT *, coalesce(school_name, '?') || ' — ' || coalesce(la_name, '?') AS label FROM schools
)"""

PRELUDE = "WITH" + RAW + "," + STAGING + "," + MARTS + "," + SHARED


def sql(body: str, extra_ctes: str = "") -> str:
    """Full oracle text: the shared chain, optional extra CTEs, then the final SELECT."""
    return PRELUDE + ("," + extra_ctes if extra_ctes else "") + "\n" + body


def materialise_marts_sql() -> list[str]:
    """Statements that land raw tables, define staging views and build mart tables in DuckDB."""
    out = [f"CREATE OR REPLACE TABLE {t} AS WITH{RAW}\nSELECT * FROM {t}"
           for t in ("raw_gias", "raw_attendance", "raw_ks4")]
    out += [f"CREATE OR REPLACE VIEW {v} AS WITH{STAGING}\nSELECT * FROM {v}"
            for v in ("stg_gias", "stg_attendance", "stg_ks4")]
    out += [f"CREATE OR REPLACE TABLE {m} AS WITH{MARTS}\nSELECT * FROM {m}"
            for m in ("dim_school", "fct_attendance_weekly", "fct_ks4_results")]
    return out


# -- data checks -----------------------------------------------------------------------

def _status(fail_expr: str, severity: str) -> str:
    bad = "'warn'" if severity == "warn" else "'fail'"
    return f"CASE WHEN {fail_expr} = 0 THEN 'pass' ELSE {bad} END"


def check_row(model: str, column: str, check: str, severity: str, failures_sql: str) -> str:
    f = f"({failures_sql})"
    return (f"SELECT {q(model)} AS model, {q(column)} AS column_name, {q(check)} AS check_name, "
            f"{q(severity)} AS severity, CAST({f} AS BIGINT) AS failures, {_status(f, severity)} AS status")


def unique_sql(model, column):
    return check_row(model, column, "unique", "error",
                     f"SELECT count(*) FROM (SELECT {column} FROM {model} WHERE {column} IS NOT NULL "
                     f"GROUP BY {column} HAVING count(*) > 1)")


def not_null_sql(model, column):
    return check_row(model, column, "not_null", "error", f"SELECT count(*) FROM {model} WHERE {column} IS NULL")


def accepted_sql(model, column, values):
    return check_row(model, column, "accepted_values", "error",
                     f"SELECT count(*) FROM {model} WHERE {column} NOT IN {in_list(values)}")


def relationships_sql(model, column, parent, field):
    return check_row(model, column, "relationships", "warn",
                     f"SELECT count(*) FROM {model} c WHERE c.{column} IS NOT NULL AND NOT EXISTS "
                     f"(SELECT 1 FROM {parent} p WHERE p.{field} = c.{column})")


UNIQUE_CHECKS = [unique_sql("stg_gias", "urn"), unique_sql("stg_ks4", "urn"), unique_sql("dim_school", "urn"),
                 unique_sql("fct_attendance_weekly", "attendance_key"), unique_sql("fct_ks4_results", "ks4_key")]
NOT_NULL_CHECKS = [not_null_sql(m, c) for m, c in [
    ("stg_gias", "urn"), ("stg_gias", "la_code"), ("stg_attendance", "la_code"), ("stg_attendance", "academic_year"),
    ("stg_ks4", "urn"), ("stg_ks4", "academic_year"), ("dim_school", "urn"), ("dim_school", "la_code"),
    ("dim_school", "is_secondary"), ("fct_attendance_weekly", "attendance_key"), ("fct_attendance_weekly", "la_code"),
    ("fct_ks4_results", "ks4_key"), ("fct_ks4_results", "urn")]]
ACCEPTED_CHECKS = [accepted_sql("stg_gias", "phase", SCHOOL_PHASES),
                   accepted_sql("stg_attendance", "phase", ATTENDANCE_PHASES)]
RELATIONSHIP_CHECKS = [relationships_sql("fct_attendance_weekly", "la_code", "dim_school", "la_code"),
                       relationships_sql("fct_ks4_results", "urn", "dim_school", "urn")]


def union(rows) -> str:
    return "\nUNION ALL\n".join(rows)


# -- screen -------------------------------------------------------------------------------

_NW = f"[^{WORD_CHAR}]"
KEYWORD_RE = "(?i)(^|" + _NW + ")(" + "|".join(FORBIDDEN_WORDS) + ")($|" + _NW + ")"
SCHEMA_RE = "(?i)(^|" + _NW + ")(" + "|".join(FORBIDDEN_SCHEMAS) + ")[" + SPACE_CLASS + r"]*\."
LIMIT_RE = "(?i)(^|" + _NW + ")limit($|" + _NW + ")"
FENCE_OPEN_RE = r"(?i)\A```(?:sql)?[" + SPACE_CLASS + "]*"
FENCE_CLOSE_RE = "[" + SPACE_CLASS + r"]*```\z"
TRIM_RE = r"\A[" + SPACE_CLASS + r"]+|[" + SPACE_CLASS + r"]+\z"

SCREEN_CTES = f"""
texts AS (
  SELECT conv_id, turn, role, sql, sql AS stripped FROM (
    SELECT conv_id, turn, role, regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
      answer, {q(TRIM_RE)}, '', 'g'), {q(FENCE_OPEN_RE)}, ''), {q(FENCE_CLOSE_RE)}, ''), {q(TRIM_RE)}, '', 'g'), ';+\\z', ''), {q(TRIM_RE)}, '', 'g') AS sql
    FROM (
      SELECT conv_id, turn, role, CASE (conv_id + turn) % 8
        WHEN 1 THEN 'select ''' || t || ''' as t from dim_school'
        WHEN 2 THEN 'select 1; select ''' || t || ''' as t'
        WHEN 3 THEN 'with t as (select ''' || t || ''' as x) select * from t -- drop'
        WHEN 4 THEN 'select ''' || t || ''' as t from raw.gias'
        WHEN 5 THEN '```sql' || chr(10) || 'select ''' || t || ''' as t' || chr(10) || '```'
        WHEN 6 THEN 'select ''' || t || ''' as t from dim_school limit 5'
        WHEN 7 THEN '  WITH t AS (select ''' || t || ''' AS x) SELECT * FROM t;  '
        ELSE coalesce(text, '') END AS answer
      FROM (SELECT *, replace(coalesce(text, ''), '''', '''''') AS t FROM conversations)))
),
rules AS (
  SELECT conv_id, turn, role, sql,
         (starts_with(lower(stripped), 'select') OR starts_with(lower(stripped), 'with')) AS select_only,
         NOT contains(regexp_replace(stripped, ';+\\z', ''), ';') AS single_statement,
         NOT regexp_matches(coalesce(sql, ''), {q(KEYWORD_RE)}) AS no_keywords,
         NOT regexp_matches(stripped, {q(SCHEMA_RE)}) AS no_schemas,
         regexp_matches(coalesce(sql, ''), {q(LIMIT_RE)}) AS has_limit
  FROM texts
),
verdicts AS (
  SELECT conv_id, turn, sql, has_limit,
         CASE WHEN NOT select_only THEN 'not_select'
              WHEN NOT single_statement THEN 'multiple_statements'
              WHEN NOT no_keywords THEN 'keyword'
              WHEN NOT no_schemas THEN 'schema'
              ELSE 'ok' END AS rule
  FROM rules
)"""
