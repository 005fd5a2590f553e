"""Casts from the all-text raw layer.

* ``strict_int`` - keys and years: bad text must fail the job (ANSI cast).
* ``try_int``    - counts that may carry a suppression marker: bad text is NULL.
* ``suppressed_to_null`` - measures: only text shaped like a number becomes a double;
  suppression markers (``c x z low``), ``NaN``, ``Infinity`` and Java literal suffixes
  (``5d``, ``12.5f``) become NULL.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from edustar.schema import NUMERIC_PATTERN


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_int(c) -> Column:
    """Text -> int; bad text raises, whether the session casts by ANSI rules or not."""
    col = _col(c)
    value = col.try_cast("int")
    bad = F.concat(F.lit("CAST_INVALID_INPUT: not an integer: "), col)
    return F.when(col.isNotNull() & value.isNull(), F.raise_error(bad).cast("int")).otherwise(value)


def try_int(c) -> Column:
    """Text -> int or NULL."""
    return _col(c).try_cast("int")


def suppressed_to_null(c) -> Column:
    """Text -> double, NULL unless the text is a plain decimal number."""
    col = _col(c)
    return F.when(col.rlike(NUMERIC_PATTERN), col.try_cast("double"))
