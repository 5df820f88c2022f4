"""Staged datasets: one folder per table. A run is written beside those before it and published by its manifest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, functions as F, types as T

from starmill.schemas.records import NAMESPACE, record_document
from starmill.sources.folders import dataset_path
from starmill.sources.manifest import Manifest, data_files, prune, publish
from starmill.storage import packed, remove_folder, version


def _with_facts(schema: T.StructType, rows: int, counts: dict[str, int]) -> T.StructType:
    """The schema, with whether the counted columns had a missing value among their metadata."""
    return T.StructType(
        [
            T.StructField(f.name, f.dataType, True, {**(f.metadata or {}), "nullable": counts[f.name] < rows})
            if f.name in counts
            else T.StructField(f.name, f.dataType, True, f.metadata)
            for f in schema
        ]
    )


def stage(
    df: DataFrame,
    root: str,
    table: str,
    fmt: str = "parquet",
    observe: Sequence[str] = (),
    namespace: str = NAMESPACE,
    doc: str = "",
    keep: int = 1,
) -> str:
    """Writes a table to the staging root and publishes it. A table without rows keeps its schema.

    A write that fails, or a driver that is lost, leaves what was published before. Readers of the run before
    can go on: ``keep`` earlier runs stay. Rows, and missing values of the columns to ``observe``, are counted
    while the rows are written. One writer at a time may stage a table.
    """
    spark, path, run = df.sparkSession, dataset_path(root, table, fmt), version()
    seen = Observation()
    counts = [F.count(F.col(f"`{name}`")).alias(f"n{i}") for i, name in enumerate(observe)]
    try:
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts).write.format(fmt).options(**packed(fmt)).save(f"{path}/{run}")
    except BaseException:
        remove_folder(spark, f"{path}/{run}")
        raise
    facts = seen.get
    schema = _with_facts(df.schema, facts["rows"], {name: facts[f"n{i}"] for i, name in enumerate(observe)})
    record = record_document(schema, table, namespace, doc)
    publish(spark, path, Manifest(run, fmt, facts["rows"], data_files(spark, f"{path}/{run}"), schema, record))
    prune(spark, path, keep)
    return path
