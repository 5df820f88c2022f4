"""Number columns: single floats, integer averages, bits, money."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

MONEY = T.DecimalType(19, 4)


def widen_float(c: Column) -> Column:
    """Single to double through text, so that 0.15 stays 0.15 and not 0.15000000596."""
    return c.cast("string").cast("double")


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def bit(c: Column) -> Column:
    """Any non-zero number is true, NULL stays NULL."""
    return c != F.lit(0)


def truncated_ratio(total: Column, n: Column) -> Column:
    """Integer division towards zero, NULL when there was nothing to divide by."""
    safe = F.when(n != F.lit(0), n)
    return F.call_function("div", total, safe)


def half_up_ratio(total: Column, n: Column, dtype: T.DecimalType = MONEY) -> Column:
    """Exact decimal quotient rounded half up to ``dtype``, NULL when ``n`` is zero."""
    safe = F.when(n != F.lit(0), n)
    return (total / safe.cast(T.DecimalType(20, 0))).cast(dtype)
