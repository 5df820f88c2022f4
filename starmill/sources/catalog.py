"""Tables of the session catalog."""

from __future__ import annotations

import json
from dataclasses import dataclass
from typing import ClassVar

from pyspark.sql import DataFrame, SparkSession, functions as F

# What marks the tables that stand in while a plain table is replaced.
NEW, OLD = "__new_", "__old_"

# Properties of a view that stands for a table: the folder of the version it shows, its format, and the names of
# the versions before it that are kept.
VERSION, FORMAT, EARLIER = "starmill.version", "starmill.format", "starmill.earlier"


def quoted(*names: str) -> str:
    return ".".join("`" + x.replace("`", "``") + "`" for x in names)


def text_literal(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def table_properties(spark: SparkSession, db: str, table: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(db, table)}").collect()}


def published_version(spark: SparkSession, db: str, table: str) -> str | None:
    """The folder that a replaced table shows; None for plain tables and plain views."""
    return table_properties(spark, db, table).get(VERSION)


def list_tables(spark: SparkSession, db: str) -> list[str]:
    """Base tables of one database, plain ones and replaced ones: no other views, no temporary views, no
    tables of an unfinished swap."""
    return sorted(
        t.name
        for t in spark.catalog.listTables(db)
        if not t.isTemporary and NEW not in t.name and OLD not in t.name and _is_table(spark, db, t)
    )


def _is_table(spark: SparkSession, db: str, t) -> bool:
    return t.tableType not in ("VIEW", "TEMPORARY") or published_version(spark, db, t.name) is not None


def describe_tables(spark: SparkSession) -> DataFrame:
    """One row per table and view of every database."""
    rows = [
        (db.name, t.name, t.tableType, t.isTemporary)
        for db in spark.catalog.listDatabases()
        for t in spark.catalog.listTables(db.name)
    ]
    return spark.createDataFrame(
        rows, "table_schema string, table_name string, table_type string, is_temporary boolean"
    )


def described(spark: SparkSession, db: str, table: str) -> dict:
    """All that the catalog knows of a table, as it describes it."""
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(db, table)} AS JSON").first()[0])


def declared_types(spark: SparkSession, db: str, table: str) -> list[str]:
    """Types of a table's columns as declared, lengths included."""
    rows = spark.sql(f"DESCRIBE TABLE {quoted(db, table)}").collect()
    names = [r["col_name"] for r in rows]
    # what follows the columns has a heading
    end = next((i for i, x in enumerate(names) if not x or x.startswith("#")), len(rows))
    return [r["data_type"] for r in rows[:end]]


_DESCRIBED = (
    "table_name string, namespace array<string>, type string, provider string, location string, comment string, "
    "table_properties map<string,string>, "
    "columns array<struct<name:string,nullable:boolean,comment:string,default:string>>"
)


def describe_columns(spark: SparkSession, db: str | None = None) -> DataFrame:
    """The metadata of one database or all of them as a table: one row per column of every table and view.

    table_schema, table_name, table_type (REPLACED for a view that stands for a table), table_comment, format, location, then
    column_name, position from 1 on, data_type as declared, nullable, column_comment, column_default. A required column of a
    declared table is not nullable, whatever its files allow. The driver lists names; descriptions are taken apart by one plan.
    """
    names = [db] if db else [d.name for d in spark.catalog.listDatabases()]
    rows = [
        (json.dumps(described(spark, name, t.name)), declared_types(spark, name, t.name))
        for name in names
        for t in spark.catalog.listTables(name)
        if not t.isTemporary
    ]
    listed = spark.createDataFrame(rows, "text string, types array<string>")
    parsed = listed.select(F.from_json("text", _DESCRIBED).alias("t"), "types").select("t.*", "types")
    property_ = F.col("table_properties")
    version = property_[VERSION]
    required = F.split(F.coalesce(property_["starmill.required"], F.lit("")), ",")
    return parsed.select("*", F.posexplode_outer("columns").alias("at", "c")).select(
        F.element_at("namespace", -1).alias("table_schema"),
        "table_name",
        F.when(version.isNotNull(), "REPLACED").otherwise(F.col("type")).alias("table_type"),
        F.col("comment").alias("table_comment"),
        F.coalesce(property_[FORMAT], "provider").alias("format"),
        F.coalesce("location", version).alias("location"),
        F.col("c.name").alias("column_name"),
        (F.col("at") + 1).alias("position"),
        F.get("types", F.col("at")).alias("data_type"),
        (F.col("c.nullable") & ~F.array_contains(required, F.col("c.name"))).alias("nullable"),
        F.col("c.comment").alias("column_comment"),
        F.col("c.default").alias("column_default"),
    )


@dataclass(frozen=True)
class CatalogSource:
    spark: SparkSession
    db: str

    stable: ClassVar[bool] = True

    def tables(self) -> list[str]:
        return list_tables(self.spark, self.db)

    def read(self, table: str) -> DataFrame:
        """A table; the blanks that fill up a text of fixed length do not count."""
        df = self.spark.table(quoted(self.db, table))
        padded = [f.name for f in df.schema if f.metadata.get("__CHAR_VARCHAR_TYPE_STRING", "").startswith("char(")]
        return df.withColumns({x: F.rtrim(quoted(x)) for x in padded}) if padded else df
