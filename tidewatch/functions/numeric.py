"""Column expressions for numeric cleaning and safe arithmetic (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_INF = float("inf")


def finite_or_null(c: Column) -> Column:
    """Cast to double and map NaN, +/-Infinity and what is no number to NULL.

    Spark keeps NaN as a value (it is counted and poisons avg/stddev); the rolling
    statistics must treat it, and infinities, as missing cells.
    """
    d = c.try_cast("double")
    return F.when(F.isnan(d) | (F.abs(d) == F.lit(_INF)), F.lit(None).cast("double")).otherwise(d)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den, NULL when den is 0 or NULL (no ANSI divide-by-zero error)."""
    return F.try_divide(num, F.nullif(den, F.lit(0.0)))


def rounded(c: Column, digits: int = 6) -> Column:
    return F.round(c.cast("double"), digits)
