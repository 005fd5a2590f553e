"""Fixed values the results depend on, and the table schemas.

Everything in the "fixed values" block must equal the values of the original
pipeline for results to agree; it is stated here once, as plain text.
"""


# ---------------------------------------------------------------------------
# Fixed values (must match the original pipeline)
# ---------------------------------------------------------------------------

# Register columns kept at landing: source header -> landed name.
REGISTER_COLUMNS = {
    "URN": "urn",
    "EstablishmentName": "establishment_name",
    "PhaseOfEducation (name)": "phase_name",
    "LA (code)": "la_code",
    "LA (name)": "la_name",
    "EstablishmentStatus (name)": "establishment_status",
    "GOR (name)": "region_name",
}

# Establishment statuses kept by the open-school filter.
OPEN_STATUSES = ("Open", "Open, but proposed to close")

# Accepted school phases in the register.
SCHOOL_PHASES = (
    "Primary", "Secondary", "Nursery", "16 plus", "All-through",
    "Middle deemed secondary", "Middle deemed primary", "Not applicable",
)

# Accepted attendance phases (school_type after the Total row is dropped).
ATTENDANCE_PHASES = ("Primary", "Secondary", "Special")

# Phases counted as secondary for the cross-fact insight.
SECONDARY_PHASES = ("Secondary", "All-through")

# The nine English regions named in the query guidance.

# Suppression markers of the statistics releases.

# Label for facts whose LA has no region in the dimension.
UNMAPPED_REGION = "(unmapped)"

# Attendance rows kept by staging.
LA_LEVEL = "Local authority"
TOTAL_PHASE = "Total"
HEADLINE_BREAKDOWN = "Total"
MIN_SESSIONS = 1000

# Text the CSV reader of the original pipeline turns into NULL.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Words that make a query text not read-only (whole words, any case).
FORBIDDEN_WORDS = (
    "insert", "update", "delete", "drop", "alter", "create", "truncate", "merge",
    "grant", "revoke", "call", "use", "copy", "put", "remove", "comment", "execute",
)

# Schema prefixes a query text may not name.
FORBIDDEN_SCHEMAS = ("raw", "information_schema", "snowflake")

# Row cap added to a query text without its own limit.
AUTO_LIMIT_ROWS = 1000

# Screen messages, in rule order.
SCREEN_MESSAGES = {
    "not_select": "Only SELECT queries are allowed.",
    "multiple_statements": "Only a single statement is allowed.",
    "keyword": "Query contains a non-read-only keyword.",
    "schema": "Query may only use the analytics marts (no raw/system schemas).",
    "ok": "ok",
}

# Dashboard display names of the school table.
SCHOOL_TABLE_COLUMNS = {
    "school_name": "School",
    "la_name": "LA",
    "region": "Region",
    "attainment8_score": "Attainment 8",
    "pct_grade5_eng_maths": "% grade 5+ E&M",
    "ebacc_aps": "EBacc APS",
}

# ---------------------------------------------------------------------------
# Patterns (Java regex, also valid RE2 for the DuckDB oracle)
# ---------------------------------------------------------------------------

# A number as text: optional sign, digits with an optional fraction, optional exponent.
NUMERIC_PATTERN = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*$"

# Characters that form words (letters, digits, underscore, in any script).
WORD_CHAR = r"\p{L}\p{N}_"

# Whitespace as Python's str.strip() sees it.
SPACE_CLASS = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

#: The column that identifies a row of each mart (guarded by the uniqueness checks).
MART_KEYS = {"dim_school": "urn", "fct_attendance_weekly": "attendance_key", "fct_ks4_results": "ks4_key"}
