"""Integrity rules as jobs that return the rows which break them.

Every function returns ``rule, table, key, detail, n_rows``. ``key`` is a JSON object of the
key columns; ``n_rows`` is the number of table rows behind the line.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmill.schemas.tables import Table

COLUMNS = ("rule", "table", "key", "detail", "n_rows")
SCHEMA = "rule string, table string, key string, detail string, n_rows long"


@dataclass(frozen=True)
class RowRule:
    """``broken`` is true for a violating row; NULL counts as kept."""

    name: str
    broken: Column
    detail: Column


class BrokenRules(Exception):
    """Raised by ``require_clean``; the message names some of the violations."""


def not_null(column: str) -> RowRule:
    return RowRule(f"not_null:{column}", F.col(column).isNull(), F.lit("NULL"))


def max_length(column: str, length: int) -> RowRule:
    c = F.col(column)
    return RowRule(
        f"length:{column}",
        F.length(F.rtrim(c)) > length,
        F.concat(F.length(F.rtrim(c)).cast("string"), F.lit(f" > {length}")),
    )


def between(column: str, low, high) -> RowRule:
    c = F.col(column)
    return RowRule(f"range:{column}", ~c.between(low, high), c.cast("string"))


def check(name: str, passes: Column, detail: Column | None = None) -> RowRule:
    return RowRule(f"check:{name}", ~passes, F.lit("check failed") if detail is None else detail)


def _key_json(columns: Sequence[str]) -> Column:
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def row_violations(
    df: DataFrame, table: str, key: Sequence[str], rules: Sequence[RowRule]
) -> DataFrame:
    """All row rules of a table in a single scan; one line per row and broken rule.

    Kept rows are dropped before any line is built.
    """
    if not rules:
        return df.sparkSession.createDataFrame([], SCHEMA)
    hits = [
        F.when(r.broken, F.struct(F.lit(r.name).alias("rule"), r.detail.alias("detail")))
        for r in rules
    ]
    some = reduce(lambda a, b: a | b, [F.coalesce(r.broken, F.lit(False)) for r in rules])
    found = df.filter(some).select(
        _key_json(key).alias("key"), F.explode(F.array_compact(F.array(*hits))).alias("hit")
    )
    return found.select(
        "hit.rule", F.lit(table).alias("table"), "key", "hit.detail", F.lit(1).cast("long").alias("n_rows")
    )


def key_violations(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Duplicate keys and keys with a NULL part. Counts combine before the shuffle."""
    return _broken_keys(df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")), table, key)


def _broken_keys(counted: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    has_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in key])
    return counted.filter((F.col("n_rows") > 1) | has_null).select(
        F.lit("primary_key").alias("rule"),
        F.lit(table).alias("table"),
        _key_json(key).alias("key"),
        F.when(has_null, F.lit("NULL in key")).otherwise(F.lit("duplicate")).alias("detail"),
        "n_rows",
    )


def reference_violations(
    child: DataFrame,
    table: str,
    columns: Sequence[str],
    parent: DataFrame,
    parent_table: str,
    parent_columns: Sequence[str],
) -> DataFrame:
    """Child keys without a parent; a key with a NULL part passes. Works for a self reference.

    The child shrinks to its distinct keys before the join, so a key that owns a large part of
    the rows is one row by then.
    """
    counted = child.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    return _missing_parents(counted, table, columns, parent, parent_table, parent_columns)


def _missing_parents(
    counted: DataFrame,
    table: str,
    columns: Sequence[str],
    parent: DataFrame,
    parent_table: str,
    parent_columns: Sequence[str],
) -> DataFrame:
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    keys = counted.filter(complete)
    known = parent.select(*[F.col(p).alias(f"__p{i}") for i, p in enumerate(parent_columns)])
    same = reduce(
        lambda a, b: a & b, [F.col(c) == F.col(f"__p{i}") for i, c in enumerate(columns)]
    )
    return keys.join(known, same, "left_anti").select(
        F.lit(f"foreign_key:{','.join(columns)}").alias("rule"),
        F.lit(table).alias("table"),
        _key_json(columns).alias("key"),
        F.lit(f"not in {parent_table}").alias("detail"),
        "n_rows",
    )


def level_violations(
    employees: DataFrame, jobs: DataFrame, first_job: int = 1, first_level: int = 10
) -> DataFrame:
    """The first job expects the lowest level; any other job's level lies in the job's range.

    A missing level breaks neither rule, and an unknown job is the foreign key's business.
    """
    job, level = F.col("job_id"), F.col("job_lvl")
    ranges = jobs.select("job_id", "min_lvl", "max_lvl")
    first = (job == first_job) & (level != first_level)
    outside = ~level.between(F.col("min_lvl"), F.col("max_lvl"))
    rule = F.when(first, F.lit("first_job_level")).when(outside, F.lit("job_level"))
    detail = F.when(first, F.lit(f"job {first_job} expects the level {first_level}")).otherwise(
        F.concat_ws(
            " ",
            F.lit("job"),
            job.cast("string"),
            F.lit("expects"),
            F.col("min_lvl").cast("string"),
            F.lit("to"),
            F.col("max_lvl").cast("string"),
        )
    )
    joined = employees.select("emp_id", "job_id", "job_lvl").join(ranges, "job_id")
    return joined.withColumn("rule", rule).filter(F.col("rule").isNotNull()).select(
        "rule",
        F.lit("employee").alias("table"),
        _key_json(["emp_id"]).alias("key"),
        detail.alias("detail"),
        F.lit(1).cast("long").alias("n_rows"),
    )


def row_rules(table: Table) -> list[RowRule]:
    """The row rules a table's declaration implies."""
    rules = []
    for f in table.fields:
        if f.required:
            rules.append(not_null(f.name))
        if f.max_length is not None:
            rules.append(max_length(f.name, f.max_length))
        if f.bounds is not None:
            rules.append(between(f.name, *f.bounds))
    rules += [check(c.name, c.passes()) for c in table.checks]
    return rules


def _key_counts(df: DataFrame, keys: Sequence[Sequence[str]]) -> DataFrame:
    """How often each value of each key occurs, all keys from one scan and one shuffle.

    ``at`` is the key's place in ``keys``; its values are in its own struct column k0, k1, ..., the other
    structs are null.
    """
    every = [
        F.struct(
            F.lit(i).alias("at"),
            *[
                (F.struct(*key) if i == j else F.lit(None)).cast(df.select(F.struct(*key)).schema[0].dataType).alias(f"k{j}")
                for j, key in enumerate(keys)
            ],
        )
        for i in range(len(keys))
    ]
    names = ["at", *[f"k{j}" for j in range(len(keys))]]
    rows = df.select(F.explode(F.array(*every)).alias("key")).select("key.*")
    return rows.groupBy(*names).agg(F.count(F.lit(1)).alias("n_rows"))


def table_violations(
    df: DataFrame, declared: Table, tables: Mapping[str, DataFrame]
) -> list[DataFrame]:
    """Row rules of a table in one scan; its primary and foreign keys counted together in another."""
    name = declared.name
    key = declared.key or tuple(df.columns)
    parts = [row_violations(df, name, key, row_rules(declared))]
    references = [r for r in declared.references if r.table in tables]
    keys = [*([declared.key] if declared.key else []), *[r.columns for r in references]]
    if len(keys) < 2:
        parts += [key_violations(df, name, declared.key)] if declared.key else []
        parts += [
            reference_violations(df, name, r.columns, tables[r.table], r.table, r.parent_columns) for r in references
        ]
        return parts
    counts = _key_counts(df, keys)

    def counted(at: int) -> DataFrame:
        return counts.filter(F.col("at") == at).select(f"k{at}.*", "n_rows")

    if declared.key:
        parts.append(_broken_keys(counted(0), name, declared.key))
    for at, r in enumerate(references, len(keys) - len(references)):
        parts.append(_missing_parents(counted(at), name, r.columns, tables[r.table], r.table, r.parent_columns))
    return parts


def violations(tables: Mapping[str, DataFrame], schema: Mapping[str, Table]) -> DataFrame:
    """Every rule of every declared table that is present; tables without a declaration have no rules."""
    parts = []
    for name, df in tables.items():
        if name in schema:
            parts += table_violations(df, schema[name], tables)
    if {"employee", "jobs"} <= tables.keys() and {"employee", "jobs"} <= schema.keys():
        parts.append(level_violations(tables["employee"], tables["jobs"]))
    if not parts:
        return SparkSession.active().createDataFrame([], SCHEMA)
    return reduce(DataFrame.unionByName, parts)


def rule_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("rule", "table").agg(
        F.count(F.lit(1)).alias("violations"), F.sum("n_rows").alias("n_rows")
    )


def require_clean(found: DataFrame, show: int = 5) -> None:
    """Raises when there is any violation; the message shows a few."""
    some = found.take(show)
    if some:
        lines = "; ".join(f"{r['table']} {r['rule']} {r['key']}" for r in some)
        raise BrokenRules(lines)
