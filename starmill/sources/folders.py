"""Folders that hold one dataset per table, named ``<table>.<format>``, at any depth."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from typing import ClassVar

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmill.sources.manifest import FOLDER, IncompleteDataset, Manifest, check_files, published
from starmill.storage import Entry, entries, exists, is_folder

log = logging.getLogger(__name__)

# Formats whose folders are datasets, not folders of datasets.
FORMATS = ("parquet", "orc", "avro", "json", "csv", "text")

COMPLETE, FOREIGN, BROKEN, UNFINISHED = "complete", "foreign", "broken", "unfinished"


class NothingStaged(ValueError):
    """There is no dataset of the wanted format below the folder."""


class AmbiguousDataset(ValueError):
    """Several datasets below the folder have one table's name."""


@dataclass(frozen=True)
class Dataset:
    """``state``: complete (as its manifest says), foreign (written by others, without a manifest), broken (differs from its
    manifest) or unfinished (a first write failed, so there is nothing to read)."""

    table: str
    path: str
    state: str
    manifest: Manifest | None = None

    @property
    def readable(self) -> bool:
        return self.state in (COMPLETE, FOREIGN)

    def read(self, spark: SparkSession, fmt: str) -> DataFrame:
        if not self.readable:
            raise IncompleteDataset(f"{self.path} is {self.state}")
        if self.manifest:
            return spark.read.format(fmt).schema(self.manifest.schema).load(f"{self.path}/{self.manifest.run}")
        return spark.read.format(fmt).load(self.path)


def table_name(path: str, fmt: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1].removesuffix(f".{fmt}")


def table_name_column(path: Column, fmt: str) -> Column:
    """The table name as a column, from the path of the file a row was read from."""
    return F.regexp_extract(path, rf"([^/]+)\.{fmt}(/|$)", 1)


def dataset_path(root: str, table: str, fmt: str) -> str:
    return f"{root.rstrip('/')}/{table}.{fmt}"


def dataset(spark: SparkSession, path: str, fmt: str) -> Dataset:
    """One dataset and its state."""
    table = table_name(path, fmt)
    if not is_folder(spark, path):
        return Dataset(table, path, FOREIGN)
    found = published(spark, path)
    if found:
        try:
            check_files(spark, path, found[0])
        except IncompleteDataset as e:
            log.warning("%s", e)
            return Dataset(table, path, BROKEN, found[0])
        return Dataset(table, path, COMPLETE, found[0])
    inside = entries(spark, path)
    own = any(x.name == FOLDER for x in inside)
    files = any(not x.hidden and not x.is_folder for x in inside)
    writing = any(x.name == "_temporary" for x in inside)
    return Dataset(table, path, FOREIGN if files and not own and not writing else UNFINISHED)


def _paths(spark: SparkSession, folder: str, fmt: str) -> tuple[list[str], list[str]]:
    """Paths of datasets at any depth, and of what is none."""
    found, skipped, todo = [], [], [folder]
    while todo:
        for entry in entries(spark, todo.pop()):
            if entry.hidden:
                continue
            if entry.name.endswith(f".{fmt}"):
                found.append(entry.path)
            elif entry.is_folder and not _other_format(entry):
                todo.append(entry.path)
            else:
                skipped.append(entry.path)
    return sorted(found), sorted(skipped)


def _other_format(entry: Entry) -> bool:
    return entry.name.rsplit(".", 1)[-1] in FORMATS


def inspect(spark: SparkSession, root: str, fmt: str = "parquet") -> list[Dataset]:
    """Every dataset below ``root`` with its state. What is of another format is skipped with a log line."""
    found, skipped = _paths(spark, root, fmt)
    if skipped:
        log.warning("not of format %s, skipped: %s", fmt, skipped)
    return [dataset(spark, path, fmt) for path in found]


def staged(spark: SparkSession, root: str, fmt: str = "parquet") -> dict[str, Dataset]:
    """Datasets below ``root`` that can be read, by table; raises when there are none, or two of one name.

    Broken and unfinished datasets are left out with a log line.
    """
    out: dict[str, Dataset] = {}
    for x in inspect(spark, root, fmt):
        if not x.readable:
            log.warning("%s dataset, left out: %s", x.state, x.path)
        elif x.table in out:
            raise AmbiguousDataset(f"{x.table}: {out[x.table].path} and {x.path}")
        else:
            out[x.table] = x
    if not out:
        raise NothingStaged(f"no {fmt} dataset in {root}")
    return out


def list_staged(spark: SparkSession, root: str, fmt: str = "parquet") -> list[str]:
    """Names of the datasets below ``root`` that can be read."""
    return sorted(staged(spark, root, fmt))


def find_staged(spark: SparkSession, root: str, table: str, fmt: str = "parquet") -> Dataset:
    """The dataset of a table: directly below ``root``, else at any depth."""
    path = dataset_path(root, table, fmt)
    if exists(spark, path):
        return dataset(spark, path, fmt)
    found = staged(spark, root, fmt)
    if table not in found:
        raise NothingStaged(f"no {fmt} dataset of {table} in {root}")
    return found[table]


def read_staged(spark: SparkSession, root: str, table: str, fmt: str = "parquet") -> DataFrame:
    """A staged dataset with the schema it carries. ``avro`` needs Spark's Avro package."""
    return find_staged(spark, root, table, fmt).read(spark, fmt)


@dataclass(frozen=True)
class FolderSource:
    spark: SparkSession
    root: str
    fmt: str = "parquet"

    stable: ClassVar[bool] = True

    def tables(self) -> list[str]:
        return list_staged(self.spark, self.root, self.fmt)

    def read(self, table: str) -> DataFrame:
        return read_staged(self.spark, self.root, table, self.fmt)
