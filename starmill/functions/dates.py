"""Date columns: epoch milliseconds, calendar days, month-first literals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

MILLIS_PER_DAY = 86_400_000


def day_from_millis(c: Column) -> Column:
    """UTC calendar day of an epoch-millisecond column. Does not depend on the session zone."""
    return F.date_from_unix_date(F.floor(c / F.lit(MILLIS_PER_DAY)).cast("int"))


def timestamp_from_millis(c: Column) -> Column:
    return F.timestamp_millis(c)


def millis(c: Column, dtype: T.DataType) -> Column:
    """Epoch milliseconds of a date or timestamp column, as staged files hold them.

    Dates and timestamps without zone count as UTC in every session zone.
    """
    if isinstance(dtype, T.TimestampType):
        return F.unix_millis(c)
    midnight = F.unix_date(F.to_date(c)).cast("long") * F.lit(MILLIS_PER_DAY)
    if isinstance(dtype, T.DateType):
        return midnight
    minutes = F.hour(c) * F.lit(60) + F.minute(c)
    within_minute = F.floor(F.extract(F.lit("SECOND"), c) * F.lit(1000)).cast("long")
    return midnight + minutes * F.lit(60_000) + within_minute


def day(c: Column, dtype: T.DataType) -> Column:
    """Calendar day of a date, timestamp or epoch-millisecond column."""
    if isinstance(dtype, T.DateType):
        return c
    if isinstance(dtype, T.IntegralType):
        return day_from_millis(c)
    return F.to_date(c)


def day_of(df, name: str) -> Column:
    return day(F.col(name), df.schema[name].dataType)


def month_first(c: Column, last_two_digit_year: int = 2049) -> Column:
    """``6/12/94`` or ``06/12/1994`` to a timestamp without zone, NULL when it is no date.

    Two-digit years fall into the hundred years that end with ``last_two_digit_year``.
    Spark reads ``yy`` as 2000-2099, so later years move back by a century.
    """
    text = F.trim(c)
    short = day_text(F.when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$"), text), "M/d/yy")
    long = day_text(F.when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), text), "M/d/yyyy")
    moved = F.when(
        F.year(short) > last_two_digit_year, short - F.expr("interval 100 years")
    ).otherwise(short)
    return F.coalesce(moved, long)


def day_text(c: Column, pattern: str) -> Column:
    """A text day as a timestamp without zone, NULL when it is none. No session zone plays a part."""
    return F.try_to_date(c, pattern).cast("timestamp_ntz")


def iso_duration(c: Column) -> Column:
    """A day-time interval as ISO 8601 text, for example ``P1DT2H3M4.500000S``.

    Spark's interval fields carry the sign each, so does every part of the text.
    """
    parts = [F.extract(F.lit(p), c).cast("string") for p in ("DAY", "HOUR", "MINUTE", "SECOND")]
    d, h, m, s = parts
    return F.concat(
        F.lit("P"), d, F.lit("DT"), h, F.lit("H"), m, F.lit("M"), s, F.lit("S")
    )


def time_text(c: Column) -> Column:
    """Day, month name, year and milliseconds: ``09 Mar 1998 14:05:07:123``."""
    return F.date_format(c, "dd MMM yyyy HH:mm:ss:SSS")
