"""The data behind each dashboard chart and table, as Spark plans.

The original pulls every fact row to one client and filters there; here the
filter, the label columns and the group-by stay in one plan and only the (small)
result leaves the cluster.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edustar.functions import label_unmapped, period_index, period_label, school_label, week_number, year_label
from edustar.operators.insights import region_per_la, region_per_la_name
from edustar.operators.joins import lookup_join
from edustar.schema import SCHOOL_TABLE_COLUMNS, UNMAPPED_REGION

MEASURES = ("attainment8_score", "pct_grade5_eng_maths", "ebacc_aps")


# -- attendance tab ------------------------------------------------------------------

def attendance_enriched(attendance: DataFrame, dim: DataFrame, la_region: DataFrame | None = None) -> DataFrame:
    """Every fact row with region (unmapped labelled) and period columns.

    ``la_region``: an already stored ``region_per_la(dim)``, if there is one.
    """
    f = attendance.select("la_code", "academic_year", "week_label", "phase", "pct_overall_absence")
    j = lookup_join(f, region_per_la(dim) if la_region is None else la_region, "la_code", "left")
    wk = week_number("week_label")
    return j.select(
        "academic_year", "week_label", label_unmapped("region").alias("region"), "phase",
        "pct_overall_absence",
        wk.alias("week_num"),
        year_label("academic_year").alias("year_label"),
        period_index("academic_year", wk).alias("period_idx"),
        period_label("academic_year", wk).alias("period_label"),
    )


#: Stored roll-ups of the attendance fact by what their cells keep; a cell holds total and n of the absence values.
ROLLUPS = {
    "region_week": ("region", "academic_year", "week_label", "phase"),
    "region_year": ("region", "academic_year", "phase"),
}


def rollup(attendance: DataFrame, la_region: DataFrame, dims: Sequence[str]) -> DataFrame:
    """The fact's total and number of absence values per cell. Rows fold to one for each LA and cell before they meet the
    LA's region, so the join sees no fact row."""
    within = [d for d in dims if d != "region"]
    cells = attendance.groupBy("la_code", *within).agg(F.sum("pct_overall_absence").alias("total"), F.count("pct_overall_absence").alias("n"))
    if "region" not in dims:
        return cells.groupBy(*dims).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
    named = cells.join(la_region, "la_code", "left").withColumn("region", label_unmapped("region"))
    return named.groupBy(*dims).agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def smallest_rollup(needed: Sequence[str], sizes: Mapping[str, int]) -> str | None:
    """The name of the stored roll-up with the fewest cells that keeps all ``needed`` columns; None if only the fact does."""
    able = [name for name in sizes if set(needed) <= set(ROLLUPS[name])]
    return min(able, key=lambda name: (sizes[name], name)) if able else None


def rollup_view(cells: DataFrame) -> DataFrame:
    """A roll-up's cells with the label columns of ``attendance_enriched`` that its dimensions give."""
    out = cells.withColumn("year_label", year_label("academic_year"))
    if "week_label" in cells.columns:
        week = week_number("week_label")
        out = out.withColumns({"week_num": week, "period_idx": period_index("academic_year", week), "period_label": period_label("academic_year", week)})
    return out


def filter_view(enriched: DataFrame, phase: str = "Secondary", regions: Sequence[str] | None = None,
                years: Sequence[str] | None = None) -> DataFrame:
    """phase = p and region in R and year in Y; an empty or missing list means all.

    "All regions" is every mapped region: the unmapped group is not among the
    choices, so it only shows when named explicitly.
    """
    cond = F.col("phase") == phase
    if regions:
        cond = cond & F.col("region").isin(list(regions))
    else:
        cond = cond & (F.col("region") != UNMAPPED_REGION)
    if years:
        cond = cond & F.col("year_label").isin(list(years))
        # A label 'YYYY/yy' only comes from academic_year YYYY, so the year choice also
        # implies a predicate on the stored key column, which reaches the scan (and
        # prunes year folders); labels that do not parse can match no row anyway.
        if "academic_year" in enriched.columns:
            starts = sorted({int(y.split("/")[0]) for y in years if y.split("/")[0].isdigit()})
            cond = cond & F.col("academic_year").isin(starts)
    return enriched.where(cond)


def _sum_and_count(view: DataFrame) -> tuple[Column, Column]:
    """Total and number of the absence values of a group, from fact rows or from the cells of a roll-up."""
    if "total" in view.columns:
        return F.sum("total"), F.sum("n")
    return F.sum("pct_overall_absence"), F.count("pct_overall_absence")


def _mean_absence(view: DataFrame) -> Column:
    return F.try_divide(*_sum_and_count(view)).alias("mean_absence")


def absence_trend(view: DataFrame) -> DataFrame:
    """Mean absence per period and region, in period order."""
    return view.groupBy("period_idx", "period_label", "region").agg(_mean_absence(view)).orderBy("period_idx", "region")


def absence_rank(view: DataFrame) -> DataFrame:
    """Mean absence per region, highest first."""
    return view.groupBy("region").agg(_mean_absence(view)).orderBy(F.desc_nulls_last("mean_absence"), "region")


def attendance_headline(view: DataFrame) -> DataFrame:
    """Mean absence (NULL on an empty view), regions shown, weeks of data.

    Rows fold to one for each region and period first; the distinct counts run over those few rows.
    """
    total, n = _sum_and_count(view)
    cells = view.groupBy("region", "period_idx").agg(total.alias("total"), n.alias("n"))
    return cells.agg(F.try_divide(F.sum("total"), F.sum("n")).alias("mean_absence"),
                     F.count_distinct("region").alias("n_regions"),
                     F.count_distinct("period_idx").alias("n_periods"))


def filter_options(enriched: DataFrame) -> DataFrame:
    """Choices of the three filters as ``(kind, value)`` rows, each sorted distinct.

    One scan: rows fold to the distinct (region, year, phase) first (map-side), and only
    those few unfold into their three (kind, value) pairs.
    """
    pairs = F.array(
        F.struct(F.lit("region").alias("kind"), F.col("region").alias("value")),
        F.struct(F.lit("year").alias("kind"), F.col("year_label").alias("value")),
        F.struct(F.lit("phase").alias("kind"), F.col("phase").alias("value")),
    )
    out = enriched.select("region", "year_label", "phase").distinct().select(F.inline(pairs))
    out = out.where(~((F.col("kind") == "region") & (F.col("value") == UNMAPPED_REGION)))
    return out.distinct().orderBy("kind", "value")


# -- attainment tab ---------------------------------------------------------------

def schools_enriched(ks4: DataFrame, dim: DataFrame, la_region_by_name: DataFrame | None = None) -> DataFrame:
    """Every result row named from the results data, region looked up by LA name.

    ``la_region_by_name``: an already stored ``region_per_la_name(dim)``, if there is one.
    """
    f = ks4.select("urn", "school_name", "la_name", *MEASURES)
    lookup = region_per_la_name(dim) if la_region_by_name is None else la_region_by_name
    j = lookup_join(f, lookup, "la_name", "left")
    return j.select("urn", "school_name", "la_name", "region", *MEASURES)


def search_name(schools: DataFrame, query: str | None) -> DataFrame:
    """Case-insensitive regular-expression match on the name; empty query keeps all."""
    if not query:
        return schools
    return schools.where(F.coalesce(F.col("school_name").rlike("(?i)" + query), F.lit(False)))


def search_ilike(ks4: DataFrame, text: str) -> DataFrame:
    """Partial, case-insensitive name match (SQL ILIKE '%text%')."""
    return ks4.where(F.col("school_name").ilike(f"%{text}%"))


def measure_present(df: DataFrame, measure: str = "attainment8_score") -> DataFrame:
    return df.where(F.col(measure).isNotNull())


def filter_la_name(df: DataFrame, la_name: str) -> DataFrame:
    return df.where(F.col("la_name") == la_name)


def school_headline(view: DataFrame) -> DataFrame:
    """Schools shown and their mean Attainment 8 (NULL scores skipped)."""
    return view.agg(F.count(F.lit(1)).alias("n_schools"), F.avg("attainment8_score").alias("mean_attainment8"))


def schools_by_score(view: DataFrame) -> DataFrame:
    """The school table: six display columns, best score first, missing scores last."""
    ordered = view.orderBy(F.desc_nulls_last("attainment8_score"), F.asc("urn"))
    return ordered.select(*[F.col(src).alias(dst) for src, dst in SCHOOL_TABLE_COLUMNS.items()])


def top_k_schools(ks4: DataFrame, la_name: str, k: int = 5, measure: str = "attainment8_score") -> DataFrame:
    """Top k schools of one LA by a measure (NULLs excluded); a top-k, so the limit is the feature."""
    df = measure_present(filter_la_name(ks4, la_name), measure)
    return (df.orderBy(F.desc(measure), F.asc("urn")).limit(k)
            .select("urn", "school_name", "la_name", measure))


# -- compare tab ----------------------------------------------------------------------

def school_labels(schools: DataFrame) -> DataFrame:
    """Sorted distinct 'name — LA' labels."""
    return schools.select(school_label().alias("label")).distinct().orderBy("label")


def first_match(schools: DataFrame, label: str) -> DataFrame:
    """The first school with a label: smallest urn wins among duplicates."""
    return (schools.where(school_label() == label)
            .orderBy(F.asc_nulls_last("urn")).limit(1))


def compare_schools(schools: DataFrame, label_a: str, label_b: str) -> DataFrame:
    """Two labelled schools side by side, with B-minus-A deltas per measure.

    One global aggregate: ``min_by`` picks the first row (smallest urn) of each label,
    so there is no join at all, and the work is a single partial+final aggregation
    over the filtered rows. No row when either label is absent.
    """
    cols = ["urn", "school_name", "la_name", "region", *MEASURES]
    lab = school_label()
    rank = F.struct(F.col("urn").isNull(), F.col("urn"))
    row = F.struct(*[F.col(c) for c in cols])
    picked = (schools.where(lab.isin(label_a, label_b))
              .agg(F.min_by(row, F.when(lab == label_a, rank)).alias("a"),
                   F.min_by(row, F.when(lab == label_b, rank)).alias("b"))
              .where(F.col("a").isNotNull() & F.col("b").isNotNull()))
    out = [F.col(f"a.{c}").alias(f"a_{c}") for c in cols] + [F.col(f"b.{c}").alias(f"b_{c}") for c in cols]
    out += [(F.col(f"b.{m}") - F.col(f"a.{m}")).alias(f"delta_{m}") for m in MEASURES]
    return picked.select(*out)
