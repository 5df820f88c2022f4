"""Column profile of a table in one job, and the casts that follow from it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starmill.functions.dates import day_text, iso_duration, millis, month_first
from starmill.functions.numbers import nan_to_null, widen_float
from starmill.functions.text import null_as_text


@dataclass(frozen=True)
class DateForm:
    """One way to write a date as text. ``parse`` gives NULL for what is no such date.

    ``mark`` is in every text of the form: texts without it are ruled out before the pattern is tried.
    """

    name: str
    mark: str
    pattern: str
    parse: Callable[[Column], Column]


def _zoned(c: Column) -> Column:
    """A time with a zone as the UTC time. Spark wants seconds ahead of a zone."""
    with_seconds = F.regexp_replace(c, r"^(.{16})([Z+-])", "$1:00$2")
    local = F.to_utc_timestamp(with_seconds.try_cast("timestamp"), F.current_timezone())
    return local.cast("timestamp_ntz")


def _named(c: Column) -> Column:
    """A text day with a month name, long or short, whatever its case."""
    text = F.initcap(F.translate(c, "-", " "))
    forms = ("d MMM yyyy", "d MMMM yyyy", "MMM d, yyyy", "MMMM d, yyyy")
    return F.coalesce(*[day_text(text, form) for form in forms])


# The written forms that count as dates, of which a text fits at most one, and the
# years a nanosecond clock can hold, outside of which a text column stays text by default. Plain
# numbers are no dates.
DATE_FORMS = (
    DateForm("iso_day", "-", r"^\d{4}-\d{1,2}-\d{1,2}$", lambda c: day_text(c, "yyyy-M-d")),
    DateForm(
        "iso_time",
        "-",
        r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?$",
        lambda c: c.try_cast("timestamp_ntz"),
    ),
    DateForm(
        "iso_zone",
        "-",
        r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:\d{2})$",
        _zoned,
    ),
    DateForm("month_first", "/", r"^\d{1,2}/\d{1,2}/(\d{2}|\d{4})$", month_first),
    DateForm("slashed", "/", r"^\d{4}/\d{1,2}/\d{1,2}$", lambda c: day_text(c, "yyyy/M/d")),
    DateForm("day_month_name", "-", r"^\d{1,2}-[A-Za-z]{3,9}-\d{4}$", _named),
    DateForm("month_name_first", ",", r"^[A-Za-z]{3,9} \d{1,2}, \d{4}$", _named),
)
YEARS = (1678, 2261)


def is_blank(c: Column) -> Column:
    """A text without a visible character: a missing value among dates."""
    return F.trim(c) == ""


def form_number(c: Column) -> Column:
    """Which written form a text fits, counted from 1. Texts without a form's mark skip its pattern."""
    found = F.lit(None).cast("int")
    for mark in reversed(dict.fromkeys(form.mark for form in DATE_FORMS)):
        fits = F.lit(None).cast("int")
        for i, form in reversed(list(enumerate(DATE_FORMS, 1))):
            if form.mark == mark:
                fits = F.when(c.rlike(form.pattern), F.lit(i)).otherwise(fits)
        found = F.coalesce(F.when(F.contains(c, F.lit(mark)), fits), found)
    return found


def parse_form(c: Column, form: DateForm, years: tuple[int, int] = YEARS) -> Column:
    parsed = form.parse(c)
    return F.when(F.year(parsed).between(*years), parsed)


def parse_text(c: Column, number: Column) -> Column:
    """A text as a timestamp, by the form it fits; NULL when it is no date."""
    parsed = F.lit(None).cast("timestamp_ntz")
    for i, form in reversed(list(enumerate(DATE_FORMS, 1))):
        parsed = F.when(number == i, form.parse(c)).otherwise(parsed)
    return parsed


def staged_type(dtype: T.DataType) -> T.DataType:
    """The type a column is staged as."""
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return T.LongType()
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    kept = (
        T.BooleanType,
        T.BinaryType,
        T.DateType,
        T.TimestampType,
        T.TimestampNTZType,
        T.DecimalType,
    )
    return dtype if isinstance(dtype, kept) else T.StringType()


@dataclass(frozen=True)
class ColumnProfile:
    column: str
    position: int
    source_type: str
    staged_type: str
    rows: int
    nulls: int
    nullable: bool
    date_form: str | None
    logical_type: str | None


def _is_text(f: T.StructField) -> bool:
    return isinstance(f.dataType, T.StringType)


def _is_moment(f: T.StructField) -> bool:
    return isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))


def opened(df: DataFrame) -> list[str]:
    """Columns whose staged type depends on their values: texts that may be dates, and times that may be days."""
    return [f.name for f in df.schema if _is_text(f) or _is_moment(f)]


def typed_profile(f: T.StructField, position: int) -> ColumnProfile:
    """What a column's type says of it before its rows are read; its missing values are counted later."""
    logical = {T.DateType: "date", T.DayTimeIntervalType: "duration"}.get(type(f.dataType))
    return ColumnProfile(
        f.name, position, f.dataType.simpleString(), staged_type(f.dataType).simpleString(), 0, 0, True, None, logical
    )


def _midnight(c: Column) -> Column:
    return F.coalesce(F.bool_and(c == F.to_date(c).cast("timestamp_ntz")), F.lit(False))


def _null_safe(c: Column, f: T.StructField) -> Column:
    """A missing number (NaN) counts as NULL."""
    return nan_to_null(c) if isinstance(f.dataType, (T.FloatType, T.DoubleType)) else c


def _text_facts(df: DataFrame, positions: list[int], years: tuple[int, int]) -> DataFrame:
    """Facts of the text columns: one row per column.

    The texts of a row become rows of (column, text), so that one short expression serves all
    columns and compiles well, however wide the table is. A row of weight zero per column makes
    the columns of an empty table appear.
    """
    texts = [F.col(f"`{df.columns[i]}`").cast("string") for i in positions]
    cells = df.select(F.posexplode(F.array(*texts)).alias("at", "v")).withColumn("weight", F.lit(1))
    seeds = df.sparkSession.range(len(positions)).select(
        F.col("id").cast("int").alias("at"), F.lit(None).alias("v"), F.lit(0).alias("weight")
    )
    parsed = (
        cells.unionByName(seeds)
        .withColumn("form", form_number(F.col("v")))
        .withColumn("t", parse_text(F.col("v"), F.col("form")))
    )
    facts = parsed.groupBy("at").agg(
        F.sum("weight").alias("rows"),
        F.count("v").alias("n"),
        F.count_if(is_blank(F.col("v"))).alias("blank"),
        F.count_if(F.year("t").between(*years)).alias("dated"),
        F.min("form").alias("first_form"),
        F.max("form").alias("last_form"),
        _midnight(F.col("t")).alias("midnight"),
    )
    names = F.array(*[F.lit(d.name) for d in DATE_FORMS])
    one_form = F.col("first_form") == F.col("last_form")
    written = F.col("n") - F.col("blank")
    fits = (written > 0) & (F.col("dated") == written) & one_form
    return facts.select(
        F.get(F.array(*map(F.lit, positions)), F.col("at")).alias("position"),
        "rows",
        F.when(fits, written).otherwise(F.col("n")).alias("n"),
        F.when(fits, F.get(names, F.col("first_form") - 1)).alias("date_form"),
        "midnight",
    )


def _typed_facts(df: DataFrame, positions: list[int]) -> DataFrame:
    """The same facts of the other columns, from one aggregate over all of them."""
    wanted, rows = [F.count(F.lit(1)).alias("rows")], []
    for i in positions:
        f = df.schema.fields[i]
        c = F.col(f"`{f.name}`")
        wanted.append(F.count(_null_safe(c, f)).alias(f"n{i}"))
        midnight = F.lit(isinstance(f.dataType, T.DateType))
        if _is_moment(f):
            wanted.append(_midnight(c.cast("timestamp_ntz")).alias(f"m{i}"))
            midnight = F.col(f"m{i}")
        rows.append(
            F.struct(
                F.lit(i).alias("position"),
                "rows",
                F.col(f"n{i}").alias("n"),
                F.lit(None).cast("string").alias("date_form"),
                midnight.alias("midnight"),
            )
        )
    return df.agg(*wanted).select(F.inline(F.array(*rows)))


def profile(df: DataFrame, years: tuple[int, int] = YEARS) -> DataFrame:
    """One row per column: types, null count, date-likeness.

    A text column is date-like when it has a value and all its values parse in one and the same
    written form, within ``years``; blank texts then count as missing. Typed dates may be of any year. A boolean column is always nullable. A date-like column is a date when every
    value is at midnight, else a timestamp. Every column is read once.
    """
    fields = df.schema.fields
    texts = [i for i, f in enumerate(fields) if _is_text(f)]
    others = [i for i, f in enumerate(fields) if not _is_text(f)]
    parts = []
    if texts:
        parts.append(_text_facts(df, texts, years))
    if others:
        parts.append(_typed_facts(df, others))
    if not parts:
        raise ValueError("a table without columns has no profile")
    facts = reduce(DataFrame.unionByName, parts)

    def per_column(values: list) -> Column:
        return F.get(F.array(*map(F.lit, values)), F.col("position"))

    timed = per_column(
        [_is_moment(f) or isinstance(f.dataType, T.DateType) for f in fields]
    ) | F.col("date_form").isNotNull()
    spans = per_column([isinstance(f.dataType, T.DayTimeIntervalType) for f in fields])
    nulls = F.col("rows") - F.col("n")
    logical = F.when(
        timed, F.when(F.col("midnight"), F.lit("date")).otherwise(F.lit("timestamp"))
    ).when(spans, F.lit("duration"))
    staged = (
        F.when(F.col("logical_type") == "date", F.lit("date"))
        .when(F.col("logical_type") == "timestamp", F.lit("timestamp_ntz"))
        .otherwise(per_column([staged_type(f.dataType).simpleString() for f in fields]))
    )
    always_nullable = per_column([isinstance(f.dataType, T.BooleanType) for f in fields])
    return facts.withColumn("logical_type", logical).select(
        per_column([f.name for f in fields]).alias("column"),
        "position",
        per_column([f.dataType.simpleString() for f in fields]).alias("source_type"),
        staged.alias("staged_type"),
        "rows",
        nulls.alias("nulls"),
        (always_nullable | (nulls > 0)).alias("nullable"),
        "date_form",
        "logical_type",
    )


def column_profiles(df: DataFrame, years: tuple[int, int] = YEARS) -> list[ColumnProfile]:
    """The profile on the driver: one record per column of the table."""
    return [ColumnProfile(**row.asDict()) for row in profile(df, years).orderBy("position").collect()]


def normalise(
    df: DataFrame,
    profiles: list[ColumnProfile],
    null_text: str | None = None,
    dates: str = "date",
    years: tuple[int, int] = YEARS,
) -> DataFrame:
    """Casts every column to its staged type in one projection.

    ``null_text="None"`` writes that word for a missing text. ``dates="millis"`` stages dates
    and timestamps as epoch milliseconds. Whether a column had nulls, and its logical type, go along
    as metadata of its field, which Parquet files and tables keep (``staged_schema``).
    """
    if dates not in ("date", "millis"):
        raise ValueError(f"dates must be 'date' or 'millis', not {dates!r}")
    forms = {d.name: d for d in DATE_FORMS}
    by_name = {p.column: p for p in profiles}
    out = []
    for f in df.schema.fields:
        p = by_name[f.name]
        c = F.col(f"`{f.name}`")
        if p.logical_type in ("date", "timestamp"):
            if p.date_form:
                c = parse_form(c, forms[p.date_form], years)
            elif isinstance(f.dataType, T.TimestampType):
                c = c.cast("timestamp_ntz")
            c = c.cast("date") if p.logical_type == "date" else c
            if dates == "millis":
                is_date = p.logical_type == "date"
                c = millis(c, T.DateType() if is_date else T.TimestampNTZType())
        elif isinstance(f.dataType, T.DayTimeIntervalType):
            c = iso_duration(c)
        elif isinstance(f.dataType, T.FloatType):
            c = nan_to_null(widen_float(c))
        elif isinstance(f.dataType, T.DoubleType):
            c = nan_to_null(c)
        else:
            staged = staged_type(f.dataType)
            c = c.cast(staged) if staged != f.dataType else c
            if isinstance(staged, T.StringType):
                c = null_as_text(c, null_text)
        out.append(c.alias(f.name, metadata={"nullable": p.nullable, "logical_type": p.logical_type or ""}))
    return df.select(*out)


def staged_schema(df: DataFrame, table: str) -> list[tuple[str, str, bool, str | None]]:
    """(table, column, nullable, logical type) that ``normalise`` recorded with the columns of a staged or
    loaded table; a column without a record may be null and has no logical type."""
    return [
        (table, f.name, f.metadata.get("nullable", True), f.metadata.get("logical_type") or None) for f in df.schema
    ]
