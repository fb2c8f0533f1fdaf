"""Scalar column functions (all JVM-side, codegen-friendly).

Each helper returns a ``Column``; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that define the warehouse semantics we reproduce.
ISO_DATE_PATTERN = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"
DESCRIPTION_MAX_CHARS = 300


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(num: str | Column, den: str | Column) -> Column:
    """SAFE_DIVIDE: NULL when the divisor is zero or NULL (never raises)."""
    return F.try_divide(col(num), col(den))


def relative_change(x: str | Column, base: str | Column, digits: int = 6) -> Column:
    """ROUND(SAFE_DIVIDE(x - base, base), digits)."""
    x, base = col(x), col(base)
    return F.round(safe_divide(x - base, base), digits)


def safe_date(c: str | Column) -> Column:
    """SAFE_CAST(string AS DATE) with strict ISO shape.

    Spark's own cast accepts ``'2020'`` and ``'2020-01'``; the warehouse cast
    does not, so the shape is checked first.
    """
    c = col(c)
    return F.when(c.rlike(ISO_DATE_PATTERN), c.try_cast("date"))


def blank_to_null(c: str | Column) -> Column:
    c = col(c)
    return F.when(c.isNull() | (F.trim(c) == ""), F.lit(None)).otherwise(c)


def is_blank(c: str | Column) -> Column:
    c = col(c)
    return c.isNull() | (F.trim(c) == "")


def up_flag(c: str | Column) -> Column:
    """CASE WHEN x > 0 THEN 1 ELSE 0 END (NULL -> 0)."""
    return F.when(col(c) > 0, F.lit(1)).otherwise(F.lit(0))


def year_of(c: str | Column) -> Column:
    return F.year(col(c)).cast("bigint")


def quarter_of(c: str | Column) -> Column:
    return F.quarter(col(c)).cast("bigint")


def to_double(c: str | Column) -> Column:
    """pandas ``to_numeric(errors='coerce')``: bad text becomes NULL."""
    return col(c).try_cast("double")


def to_bigint(c: str | Column) -> Column:
    """Nullable integer coercion; fractional text is truncated like Int64 cast
    of an integral float, other junk becomes NULL."""
    return col(c).try_cast("double").try_cast("bigint")


def cut(c: str | Column, n: int = DESCRIPTION_MAX_CHARS) -> Column:
    return F.substring(col(c), 1, n)
