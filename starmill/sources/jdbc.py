"""Tables of a database reached over JDBC, read by many tasks at once."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from decimal import Decimal
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession


# Of the histogram behind counted splits; parts differ by one part in as many at most, but for shared values.
BUCKETS_A_PART = 8


def merged(counts: Iterable[tuple[object, int]]) -> list[tuple[object, int]]:
    """A histogram with one entry for each value: buckets that begin with one value are one."""
    out: dict[object, int] = {}
    for value, n in counts:
        out[value] = out.get(value, 0) + n
    return list(out.items())


@dataclass(frozen=True)
class Split:
    """How to cut one table: by value range of a number, date or timestamp column, or by
    predicates that cover every row once. With ``counted`` the predicates follow from a histogram of the column, which the
    database counts: parts are even however the values cluster. Without either, one task reads the table: say so for small
    tables only.
    """

    column: str | None = None
    partitions: int = 16
    predicates: tuple[str, ...] = ()
    counted: bool = False


def _literal(value) -> str:
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def equal_depth(column: str, counts: Sequence[tuple[object, int]], partitions: int) -> tuple[str, ...]:
    """Predicates that cut a table into parts of about equally many rows, each row in one of them.

    ``counts`` is a histogram: values of the column in order, none of them null, with the rows from each value up to the next
    one. Rows that share a value stay in one part. The first part takes rows below the first value, the
    last one those above the last, so a histogram may be older than the table; rows without a value are a part too.
    """
    name = quoted(column)
    total = sum(n for _, n in counts)
    cuts, before = [], 0
    for value, n in counts:
        # a cut where the rows so far reach the next share of all rows
        if before and before * partitions >= total * (len(cuts) + 1):
            cuts.append(value)
        before += n
    missing = f"{name} is null"
    if not cuts:
        return f"{name} is not null", missing
    ends = [_literal(x) for x in cuts]
    between = [f"{name} >= {a} and {name} < {b}" for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return f"{name} < {ends[0]}", *between, f"{name} >= {ends[-1]}", missing


def base_tables_query(schema: str) -> str:
    literal = schema.replace("'", "''")
    return (
        "select table_name from information_schema.tables "
        f"where table_schema = '{literal}' and table_type = 'BASE TABLE'"
    )


def quoted(name: str) -> str:
    """An identifier as standard SQL quotes it, so that mixed case and reserved words work."""
    return '"' + name.replace('"', '""') + '"'


def all_tables_query() -> str:
    return "select * from information_schema.tables"


@dataclass(frozen=True)
class JdbcSource:
    """``options`` carry url, driver, user, password and fetchsize, as Spark names them."""

    spark: SparkSession
    options: Mapping[str, str]
    schema: str = "public"
    splits: Mapping[str, Split] = field(default_factory=dict)
    stable: ClassVar[bool] = False

    def query(self, sql: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.options).option("query", sql).load()

    def tables(self) -> list[str]:
        rows = self.query(base_tables_query(self.schema)).collect()
        return sorted(r[0] for r in rows)

    def describe_tables(self) -> DataFrame:
        return self.query(all_tables_query())

    def name(self, table: str) -> str:
        return f"{quoted(self.schema)}.{quoted(table)}"

    def bounds_query(self, table: str, split: Split) -> str:
        column = quoted(split.column)
        return f"select min({column}) as low, max({column}) as high from {self.name(table)}"

    def histogram_query(self, table: str, split: Split) -> str:
        """At most BUCKETS_A_PART rows for each part: the database ranks the rows and returns the first value of each bucket."""
        column, buckets = quoted(split.column), split.partitions * BUCKETS_A_PART
        return (
            f"select min(v) as v, count(*) as n from (select {column} as v, "
            f"ntile({buckets}) over (order by {column}) as bucket from {self.name(table)} where {column} is not null) b "
            "group by bucket order by 1"
        )

    def predicates(self, table: str, split: Split) -> tuple[str, ...]:
        if not split.counted:
            return split.predicates
        rows = self.query(self.histogram_query(table, split)).collect()
        return equal_depth(split.column, merged((r[0], r[1]) for r in rows), split.partitions)

    def range_options(self, table: str, split: Split, low, high) -> dict[str, str]:
        return {
            "dbtable": self.name(table),
            "partitionColumn": quoted(split.column),
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(split.partitions),
        }

    def split(self, table: str) -> Split:
        """How a table is cut; without a declaration it is not read at all, rather than by a single task."""
        if table not in self.splits:
            raise ValueError(f"{self.name(table)} has no split: declare one, or Split() to read it in one task")
        return self.splits[table]

    def read(self, table: str) -> DataFrame:
        split, name = self.split(table), self.name(table)
        reader = self.spark.read.format("jdbc").options(**self.options)
        if split.predicates or split.counted:
            properties = {k: v for k, v in self.options.items() if k != "url"}
            predicates = list(self.predicates(table, split))
            return self.spark.read.jdbc(self.options["url"], name, predicates=predicates, properties=properties)
        if split.column is None:
            return reader.option("dbtable", name).load()
        low, high = self.query(self.bounds_query(table, split)).first()
        if low is None:
            return reader.option("dbtable", name).load()
        return reader.options(**self.range_options(table, split, low, high)).load()
