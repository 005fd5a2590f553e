"""Derived columns of the marts and of the dashboard views."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from edustar.schema import SECONDARY_PHASES, UNMAPPED_REGION


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pad_code(c, width: int = 3) -> Column:
    """Left-pad a code with zeros to ``width``; longer text is cut to ``width``."""
    return F.lpad(_col(c), width, "0")


def surrogate_key(*cols) -> Column:
    """md5 of the parts joined by ``|``; any NULL part makes the key NULL."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit("|"))
        parts.append(_col(c).cast("string"))
    return F.md5(F.concat(*parts))


def flag_secondary(phase="phase") -> Column:
    """True for Secondary and All-through; NULL phase gives NULL."""
    return _col(phase).isin(*SECONDARY_PHASES)


def label_unmapped(region="region") -> Column:
    return F.coalesce(_col(region), F.lit(UNMAPPED_REGION))


def week_number(week_label="week_label") -> Column:
    """First run of digits in the week label as int; NULL when there is none."""
    return F.regexp_extract(_col(week_label), r"(\d+)", 1).try_cast("int")


def year_label(year="academic_year") -> Column:
    """2022 -> '2022/23'."""
    y = _col(year)
    return F.concat(y.cast("string"), F.lit("/"), F.substring((y + 1).cast("string"), 3, 1 << 20))


def period_index(year="academic_year", week=None) -> Column:
    """year * 100 + week number, a missing week counting as 0."""
    wk = week_number() if week is None else _col(week)
    return _col(year) * 100 + F.coalesce(wk, F.lit(0))


def period_label(year="academic_year", week=None) -> Column:
    """'2022/23 W05'; the week is zero-padded to two digits, never cut."""
    wk = week_number() if week is None else _col(week)
    return F.concat(year_label(year), F.lit(" W"), F.format_string("%02d", F.coalesce(wk, F.lit(0))))


def school_label(name="school_name", la="la_name") -> Column:
    """'name — LA' with a missing part shown as '?'."""
    return F.concat(F.coalesce(_col(name), F.lit("?")), F.lit(" — "), F.coalesce(_col(la), F.lit("?")))
