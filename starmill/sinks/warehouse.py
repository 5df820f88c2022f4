"""Warehouse tables: full refresh that readers do not notice, declared tables, views."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from starmill.schemas.tables import NOW, Field, Table
from starmill.sources.catalog import (
    EARLIER,
    FORMAT,
    NEW,
    OLD,
    VERSION,
    published_version,
    quoted,
    table_properties,
    text_literal,
)
from starmill.sources.folders import COMPLETE, Dataset, find_staged, list_staged
from starmill.sources.manifest import IncompleteDataset
from starmill.storage import entries, packed, remove_folder, version


def create_database(spark: SparkSession, db: str, location: str | None = None) -> None:
    """``location`` must be reachable by every executor."""
    where = f" LOCATION {text_literal(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(db)}{where}")


def drop_database(spark: SparkSession, db: str) -> None:
    """Drops a database with its tables."""
    spark.sql(f"DROP DATABASE IF EXISTS {quoted(db)} CASCADE")


# -- tables that are replaced --------------------------------------------------------------


def _renamed(spark: SparkSession, db: str, old: str, new: str) -> None:
    spark.sql(f"ALTER TABLE {quoted(db, old)} RENAME TO {quoted(db, new)}")


def clear_leftovers(spark: SparkSession, db: str, table: str) -> None:
    """Undoes a first publication that a lost driver left half done: the plain table comes back.

    One writer at a time may replace a table.
    """
    names = [t.name for t in spark.catalog.listTables(db)]
    for name in names:
        if name.startswith(f"{table}{OLD}") and not spark.catalog.tableExists(quoted(db, table)):
            _renamed(spark, db, name, table)
        elif name.startswith((f"{table}{OLD}", f"{table}{NEW}")):
            spark.sql(f"DROP TABLE IF EXISTS {quoted(db, name)}")


def versions_folder(spark: SparkSession, db: str, table: str) -> str:
    return f"{spark.catalog.getDatabase(db).locationUri.rstrip('/')}/{table.lower()}__versions"


def _point(spark: SparkSession, db: str, table: str, fmt: str, path: str, earlier: str, doc: str) -> None:
    """The one step that readers see: the name now stands for the rows below ``path``."""
    comment = f" COMMENT {text_literal(doc)}" if doc else ""
    facts = {VERSION: path, FORMAT: fmt, EARLIER: earlier}
    properties = ", ".join(f"{text_literal(k)} = {text_literal(v)}" for k, v in facts.items())
    spark.sql(
        f"CREATE OR REPLACE VIEW {quoted(db, table)}{comment} TBLPROPERTIES ({properties}) "
        f"AS SELECT * FROM {quoted(fmt, path)}"
    )


def replace_table(
    df: DataFrame, db: str, table: str, fmt: str = "parquet", keep: int = 1, rows: int | None = None, doc: str = ""
) -> None:
    """Replaces rows and schema of a table. ``df`` may read the table it replaces.

    Each version of a table is a folder of its own that never changes. The table's name is a view on one of them, and
    pointing it at the new version is a single change of the catalog: a reader sees the old table or the
    new one, whole, also where columns differ. ``keep`` earlier versions stay for those who still read them. A write that
    fails changes nothing. With ``rows`` a version that has another number of rows is not published.

    A plain table of the name is renamed away once, when it is replaced for the first time.
    """
    spark = df.sparkSession
    clear_leftovers(spark, db, table)
    folder = versions_folder(spark, db, table)
    plain, before = _state(spark, db, table)
    path, seen = f"{folder}/{version()}", Observation()
    kept = before[:keep]
    try:
        counted = df if rows is None else df.observe(seen, F.count(F.lit(1)).alias("rows"))
        counted.write.format(fmt).options(**packed(fmt)).save(path)
        if rows is not None and seen.get["rows"] != rows:
            raise IncompleteDataset(f"{db}.{table}: {seen.get['rows']} rows instead of {rows}")
        with _renamed_away(spark, db, table) if plain else nullcontext():
            _point(spark, db, table, fmt, path, ",".join(kept), doc)
    except BaseException:
        remove_folder(spark, path)
        raise
    for entry in entries(spark, folder):
        # earlier versions, and what lost drivers left
        if entry.name not in {path.rsplit("/", 1)[-1], *kept}:
            remove_folder(spark, entry.path)


def _state(spark: SparkSession, db: str, table: str) -> tuple[bool, list[str]]:
    """Whether there is a plain table of the name, and else its versions, the one that is shown first."""
    if not spark.catalog.tableExists(quoted(db, table)):
        return False, []
    facts = table_properties(spark, db, table)
    if VERSION not in facts:
        return True, []
    return False, [facts[VERSION].rsplit("/", 1)[-1], *filter(None, facts.get(EARLIER, "").split(","))]


@contextmanager
def _renamed_away(spark: SparkSession, db: str, table: str) -> Iterator[None]:
    """The plain table is away while its name is given to something else, and back if that fails."""
    old = f"{table}{OLD}{uuid.uuid4().hex[:12]}"
    _renamed(spark, db, table, old)
    try:
        yield
    except BaseException:
        _renamed(spark, db, old, table)
        raise
    spark.sql(f"DROP TABLE {quoted(db, old)}")


def drop_table(spark: SparkSession, db: str, table: str) -> None:
    """Drops a table of either kind, with its files; nothing if it is not there."""
    if not spark.catalog.tableExists(quoted(db, table)):
        return
    if published_version(spark, db, table) is None:
        spark.sql(f"DROP TABLE {quoted(db, table)}")
        return
    spark.sql(f"DROP VIEW {quoted(db, table)}")
    remove_folder(spark, versions_folder(spark, db, table))


def drop_tables(spark: SparkSession, db: str, tables: list[str]) -> None:
    for name in tables:
        drop_table(spark, db, name)


def load_dataset(spark: SparkSession, found: Dataset, db: str, fmt: str = "parquet") -> None:
    """Loads one staged dataset as a table of its name. Its rows must be as many as its manifest says."""
    manifest = found.manifest if found.state == COMPLETE else None
    doc = _document(manifest.record) if manifest else ""
    replace_table(found.read(spark, fmt), db, found.table, rows=manifest.rows if manifest else None, doc=doc)


def _document(record: dict) -> str:
    """Namespace, name and doc of a record schema as a table comment."""
    return f"{record['namespace']}.{record['name']}" + (f": {record['doc']}" if record["doc"] else "")


def load_table(spark: SparkSession, root: str, table: str, db: str, fmt: str = "parquet") -> None:
    load_dataset(spark, find_staged(spark, root, table, fmt), db, fmt)


def load_all(spark: SparkSession, root: str, db: str, fmt: str = "parquet") -> list[str]:
    """Loads every staged dataset; raises before any load when nothing is staged."""
    tables = list_staged(spark, root, fmt)
    for table in tables:
        load_table(spark, root, table, db, fmt)
    return tables


# -- declared tables -----------------------------------------------------------------------


def column_type(field: Field) -> str:
    """The declared type: a text of limited length is padded to it (CHAR) or not (VARCHAR)."""
    if isinstance(field.type, T.StringType) and field.max_length:
        return f"{'CHAR' if field.fixed else 'VARCHAR'}({field.max_length})"
    return field.type.simpleString().upper()


def _default(field: Field) -> str:
    if not field.has_default:
        return ""
    if field.default is NOW:
        return " DEFAULT current_timestamp()"
    value = field.default
    return f" DEFAULT {text_literal(value) if isinstance(value, str) else str(value).upper()}"


def create_statement(db: str, table: Table, fmt: str = "parquet") -> str:
    """The table's DDL: types with lengths, defaults, what is required, and the key as a property."""
    columns = [
        f"{quoted(f.name)} {column_type(f)}{' NOT NULL' if f.required else ''}{_default(f)}" for f in table.fields
    ]
    facts = {"starmill.key": ",".join(table.key), "starmill.required": ",".join(f.name for f in table.fields if f.required)}
    listed = ", ".join(f"{text_literal(k)} = {text_literal(v)}" for k, v in facts.items() if v)
    properties = f" TBLPROPERTIES ({listed})" if listed else ""
    return f"CREATE TABLE {quoted(db, table.name)} ({', '.join(columns)}) USING {fmt}{properties}"


def create_tables(spark: SparkSession, db: str, schema: Mapping[str, Table], fmt: str = "parquet") -> None:
    """Empty tables from their declarations; tables of these names go."""
    for name, table in schema.items():
        drop_table(spark, db, name)
        spark.sql(create_statement(db, table, fmt))


def _required(name: str, dtype: T.DataType, table: str) -> Column:
    missing = F.raise_error(F.lit(f"{table}.{name} is required")).cast(dtype)
    return F.coalesce(F.col(f"`{name}`").cast(dtype), missing)


def insert_rows(df: DataFrame, db: str, table: Table) -> None:
    """Appends rows with a column list, as a database takes them: all or none.

    A column that is left out takes its default, or null. Spark itself refuses texts that are too long and numbers that do not
    fit; it does not hold NOT NULL against files, so a missing value of a required column fails here.
    """
    known = {f.name: f for f in table.fields}
    unknown = [x for x in df.columns if x not in known]
    absent = [f.name for f in table.fields if f.required and not f.has_default and f.name not in df.columns]
    if unknown or absent:
        raise ValueError(f"{table.name}: unknown columns {unknown}, required columns left out {absent}")
    given = [
        _required(x, known[x].type, table.name).alias(x) if known[x].required else F.col(f"`{x}`") for x in df.columns
    ]
    names = ", ".join(quoted(x) for x in df.columns)
    df.sparkSession.sql(f"INSERT INTO {quoted(db, table.name)} ({names}) SELECT * FROM {{rows}}", rows=df.select(*given))


# -- views ---------------------------------------------------------------------------------


def create_view(df: DataFrame, name: str) -> None:
    """A view of this session."""
    df.createOrReplaceTempView(name)


def create_stored_view(spark: SparkSession, db: str, name: str, query: str, doc: str = "") -> None:
    """A view that outlives the session, on tables of the catalog. Made again after a load, it has their new columns.

    It is checked first: a query that cannot run leaves the view as it was.
    """
    spark.sql(query).schema  # noqa: B018
    comment = f" COMMENT {text_literal(doc)}" if doc else ""
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(db, name)}{comment} AS {query}")
