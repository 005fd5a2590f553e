"""Column helpers: every function takes and returns a ``Column`` (JVM-side, codegen)."""

from edustar.functions.casts import strict_int, suppressed_to_null, try_int
from edustar.functions.columns import (
    flag_secondary,
    label_unmapped,
    pad_code,
    period_index,
    period_label,
    school_label,
    surrogate_key,
    week_number,
    year_label,
)

__all__ = [
    "flag_secondary", "label_unmapped", "pad_code", "period_index", "period_label",
    "school_label", "strict_int", "suppressed_to_null", "surrogate_key", "try_int",
    "week_number", "year_label",
]
