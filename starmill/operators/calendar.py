"""The calendar dimension and the date ids that other tables take from it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from starmill.functions.dates import day_of


def last_day(as_of: dt.date | str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def first_day(df: DataFrame, column: str) -> DataFrame:
    """One row: the earliest day of a date, timestamp or epoch-millisecond column."""
    return df.agg(F.min(day_of(df, column)).alias("first"))


def calendar(df: DataFrame, column: str, as_of: dt.date | str | None = None) -> DataFrame:
    """``(date_id, date)``, one row per day from the earliest day up to ``as_of``.

    Days are consecutive, so the id is a difference of days and needs no sort. A last day
    before the first one gives an empty calendar. The day type bounds it at 3.7 million rows.
    """
    bounds = first_day(df, column).withColumn("last", last_day(as_of))
    some = F.col("first") <= F.col("last")
    days = F.sequence("first", F.greatest("first", "last"), F.expr("interval 1 day"))
    return (
        bounds.filter(some)
        .select("first", F.explode(days).alias("date"))
        .select((F.datediff("date", "first") + F.lit(1)).cast("long").alias("date_id"), "date")
    )


def date_ids(
    df: DataFrame, roles: Mapping[str, str], column: str, as_of: dt.date | str | None = None
) -> DataFrame:
    """Adds one calendar id per role without any join.

    ``roles`` maps a date column to the id column it becomes; ``column`` starts the calendar.
    Days outside the calendar, and missing days, get NULL.
    """
    last = last_day(as_of)
    ids = {}
    for source, target in roles.items():
        day = day_of(df, source)
        inside = (day >= F.col("__first")) & (day <= last)
        ids[target] = F.when(inside, (F.datediff(day, F.col("__first")) + F.lit(1)).cast("long"))
    started = df.withColumn("__first", first_day(df, column).scalar())
    return started.withColumns(ids).drop("__first")


def with_role_dates(df: DataFrame, calendar_df: DataFrame, roles: Mapping[str, str]) -> DataFrame:
    """Adds one calendar id per role by joining the given calendar once per role.

    For a calendar whose ids are not consecutive days. Spark broadcasts the calendar when its
    size allows.
    """
    for source, target in roles.items():
        lookup = calendar_df.select(F.col("date").alias("__day"), F.col("date_id").alias(target))
        df = df.join(lookup, day_of(df, source) == F.col("__day"), "left").drop("__day")
    return df
