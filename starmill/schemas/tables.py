"""How a source table is declared: the facts a database would enforce on write."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

# Stands for "the moment the row is written" among the defaults.
NOW = object()
_NO_DEFAULT = object()


@dataclass(frozen=True)
class Field:
    name: str
    type: T.DataType
    required: bool = False
    max_length: int | None = None
    bounds: tuple[int, int] | None = None
    default: object = _NO_DEFAULT
    identity: bool = False
    fixed: bool = False

    @property
    def has_default(self) -> bool:
        return self.default is not _NO_DEFAULT

    def default_column(self) -> Column:
        if not self.has_default:
            return F.lit(None).cast(self.type)
        if self.default is NOW:
            return F.current_timestamp().cast(self.type)
        return F.lit(self.default).cast(self.type)


@dataclass(frozen=True)
class Reference:
    columns: tuple[str, ...]
    table: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Check:
    """``passes`` may be NULL: like in SQL, an unknown check result is no violation."""

    name: str
    passes: Callable[[], Column]


@dataclass(frozen=True)
class Table:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ()
    references: tuple[Reference, ...] = ()
    checks: tuple[Check, ...] = ()

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.type, not f.required) for f in self.fields])

    def empty(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([], self.struct())

    def rows(self, spark: SparkSession, values: list[tuple]) -> DataFrame:
        """Literal rows in field order, for lookup tables written by hand."""
        return spark.createDataFrame(values, self.struct())

    def fill(self, df: DataFrame) -> DataFrame:
        """All fields in order; an omitted column takes its default, an explicit NULL stays."""
        missing = [f.name for f in self.fields if f.identity and f.name not in df.columns]
        if missing:
            raise ValueError(f"number the identity columns first: {missing}")
        given = set(df.columns)
        return df.select(
            *[
                (F.col(f.name).cast(f.type) if f.name in given else f.default_column()).alias(f.name)
                for f in self.fields
            ]
        )


def small(name: str, required: bool = False, **more) -> Field:
    return Field(name, T.ShortType(), required, bounds=(-32768, 32767), **more)


def tiny(name: str, required: bool = False, **more) -> Field:
    """0 to 255, which needs a short: Spark's byte ends at 127."""
    return Field(name, T.ShortType(), required, bounds=(0, 255), **more)


def whole(name: str, required: bool = False, **more) -> Field:
    return Field(name, T.IntegerType(), required, bounds=(-(2**31), 2**31 - 1), **more)


def number(name: str, required: bool = False) -> Field:
    return Field(name, T.DoubleType(), required)


def text(name: str, length: int | None = None, required: bool = False, **more) -> Field:
    return Field(name, T.StringType(), required, max_length=length, **more)


def code(name: str, length: int, required: bool = False, **more) -> Field:
    """A text of fixed length, filled up with blanks."""
    return text(name, length, required, fixed=True, **more)


def date(name: str, required: bool = False) -> Field:
    return Field(name, T.DateType(), required)


def moment(name: str, required: bool = False, **more) -> Field:
    return Field(name, T.TimestampNTZType(), required, **more)


def money(name: str) -> Field:
    return Field(name, T.DecimalType(19, 4))


def binary(name: str) -> Field:
    return Field(name, T.BinaryType())


def flag(name: str, required: bool = False) -> Field:
    return Field(name, T.BooleanType(), required)


def to(table: str, column: str, parent_column: str | None = None) -> Reference:
    return Reference((column,), table, (parent_column or column,))


def by_name(*tables: Table) -> dict[str, Table]:
    return {t.name: t for t in tables}
