"""Record schemas of staged tables: a named document, and what changed between two of them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

NAMESPACE = "staging"

# Names of plain types in record schemas. What is not listed is a string.
_PLAIN = {
    T.LongType: "long",
    T.IntegerType: "int",
    T.ShortType: "int",
    T.ByteType: "int",
    T.DoubleType: "double",
    T.FloatType: "float",
    T.BooleanType: "boolean",
    T.BinaryType: "bytes",
}


def _type(f: T.StructField):
    """The type of a staged column. Dates and times may be staged as such or in epoch milliseconds."""
    logical, dtype = f.metadata.get("logical_type"), f.dataType
    if isinstance(dtype, T.DateType):
        return {"type": "int", "logicalType": "date"}
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)) or logical in ("date", "timestamp"):
        return {"type": "long", "logicalType": "timestamp-millis"}
    if isinstance(dtype, T.DecimalType):
        return {"type": "bytes", "logicalType": "decimal", "precision": dtype.precision, "scale": dtype.scale}
    if logical == "duration":
        return {"type": "string", "logicalType": "duration"}
    return _PLAIN.get(type(dtype), "string")


def record_document(schema: T.StructType, name: str, namespace: str = NAMESPACE, doc: str = "") -> dict:
    """A named record schema; a column that may be missing is a union with null."""
    fields = []
    for f in schema:
        dtype = _type(f)
        field = {"name": f.name, "type": ["null", dtype] if f.metadata.get("nullable", True) else dtype}
        if f.metadata.get("comment"):
            field["doc"] = f.metadata["comment"]
        fields.append(field)
    return {"type": "record", "name": name, "namespace": namespace, "doc": doc, "fields": fields}


_ROWS = (
    "table string, namespace string, doc string, position int, column string, type string, logical_type string, "
    "nullable boolean, column_doc string"
)


def record_rows(spark: SparkSession, documents: Iterable[dict]) -> DataFrame:
    """One row per field of each document."""
    rows = []
    for d in documents:
        for i, field in enumerate(d["fields"]):
            union = isinstance(field["type"], list)
            dtype = field["type"][1] if union else field["type"]
            plain, logical = (dtype["type"], dtype["logicalType"]) if isinstance(dtype, dict) else (dtype, None)
            if logical == "decimal":
                plain = f"decimal({dtype['precision']},{dtype['scale']})"
            rows.append((d["name"], d["namespace"], d["doc"], i, field["name"], plain, logical, union, field.get("doc")))
    return spark.createDataFrame(rows, _ROWS)


def schema_drift(before: DataFrame, after: DataFrame) -> DataFrame:
    """(table, column, change, before, after) between two sets of ``record_rows``: columns that were added, dropped,
    retyped, or may now be missing or no longer. A table that is only in one set has all its columns added or dropped.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        kind = F.concat_ws(":", "type", "logical_type")
        return df.select("table", "column", kind.alias(name), F.col("nullable").alias(f"{name}_nullable"))

    both = side(before, "before").join(side(after, "after"), ["table", "column"], "full")
    change = (
        F.when(F.col("before").isNull(), "added")
        .when(F.col("after").isNull(), "dropped")
        .when(F.col("before") != F.col("after"), "retyped")
        .when(F.col("before_nullable") != F.col("after_nullable"), F.when(F.col("after_nullable"), "may be missing").otherwise("always there"))
    )
    return both.withColumn("change", change).filter("change is not null").select("table", "column", "change", "before", "after")
