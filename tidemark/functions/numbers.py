"""Exact percentages and averages, and casts that never fail on bad text.

Percentages are rounded half up with integer arithmetic, so results do not
depend on how a double happens to represent x.xx5.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text the payload may use for a number; `1.2.3` still matches, so the cast
# below has to tolerate it.
NUMERIC_TEXT = "^[0-9.]+$"

# Wide enough for exact averages of any amount seen in practice.
WIDE_AMOUNT = "decimal(24,8)"
_WIDE_UNITS = 10**8


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def pct_hundredths(part: str | Column, total: str | Column) -> Column:
    """100 * part / total in hundredths of a percent, half up; NULL if total = 0."""
    part = _col(part).cast("bigint")
    total = F.nullif(_col(total).cast("bigint"), F.lit(0).cast("bigint"))
    return _div(part * 20000 + total, total * 2)


def pct2(part: str | Column, total: str | Column) -> Column:
    """Percentage with two decimals as a double."""
    return pct_hundredths(part, total) / F.lit(100.0)


def per_unit2(total: str | Column, units: int) -> Column:
    """total / units with two decimals, half up, for a non-negative total."""
    total = _col(total).cast("bigint")
    return _div(total * 200 + units, F.lit(2 * units).cast("bigint")) / F.lit(100.0)


def mean2(total: str | Column, count: str | Column) -> Column:
    """Mean of WIDE_AMOUNT values with two decimals, half away from zero.

    NULL when nothing was counted.
    """
    units = (F.abs(_col(total)) * F.lit(_WIDE_UNITS)).cast("decimal(38,0)")
    count = F.nullif(_col(count).cast("bigint"), F.lit(0).cast("bigint"))
    per_cent = count.cast("decimal(20,0)") * F.lit(_WIDE_UNITS // 100).cast("decimal(10,0)")
    numerator = (units * 2 + per_cent).cast("decimal(38,0)")
    size = _div(numerator, (per_cent * 2).cast("decimal(38,0)")) / F.lit(100.0)
    return F.when(_col(total) < 0, -size).otherwise(size)


def safe_cast(c: str | Column, data_type: str) -> Column:
    """Cast that gives NULL instead of an error on malformed text."""
    return _col(c).try_cast(data_type)


def safe_amount(json_col: str | Column, field: str, data_type: str = WIDE_AMOUNT) -> Column:
    """Numeric value of a JSON text field; NULL if absent, null or not a number."""
    text = F.get_json_object(_col(json_col), f"$.{field}")
    return F.when(text.rlike(NUMERIC_TEXT), safe_cast(text, data_type))


def any_null(cols: list[str] | tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def sum_long(c: str | Column) -> Column:
    return F.sum(c).cast("bigint")
