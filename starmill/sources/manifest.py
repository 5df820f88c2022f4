"""What a staged dataset says of itself: the run that is published, its files, rows and record schema.

A dataset is a folder ``<table>.<format>`` with a folder of files for each run that is kept and a folder ``_manifest`` with
a small file for each. The manifest with the last name is the published one: it is there whole or not at all, and
it is written when the run's files are complete. A run without a manifest is what a failed write left.
"""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass

from pyspark.sql import SparkSession, types as T

from starmill.storage import entries, publish_text, read_text, remove_folder

log = logging.getLogger(__name__)

FOLDER = "_manifest"


class IncompleteDataset(ValueError):
    """Files or rows of a dataset differ from what its manifest says."""


@dataclass(frozen=True)
class Manifest:
    run: str
    format: str
    rows: int
    files: dict[str, int]
    schema: T.StructType
    record: dict

    def text(self) -> str:
        return json.dumps({**self.__dict__, "schema": self.schema.jsonValue()})

    @staticmethod
    def of(text: str) -> Manifest:
        values = json.loads(text)
        return Manifest(**{**values, "schema": T.StructType.fromJson(values["schema"])})


def data_files(spark: SparkSession, folder: str) -> dict[str, int]:
    return {x.name: x.size for x in entries(spark, folder) if not x.hidden and not x.is_folder}


def published(spark: SparkSession, path: str) -> list[Manifest]:
    """Manifests of a dataset, the published one first. What is no manifest is passed over."""
    found = []
    for entry in reversed(entries(spark, f"{path}/{FOLDER}")):
        if entry.name.endswith(".json") and not entry.hidden:
            try:
                found.append(Manifest.of(read_text(spark, entry.path)))
            except (ValueError, TypeError, KeyError) as e:
                log.warning("no manifest: %s (%s)", entry.path, e)
    return found


def publish(spark: SparkSession, path: str, manifest: Manifest) -> None:
    publish_text(spark, f"{path}/{FOLDER}/{manifest.run}.json", manifest.text())


def check_files(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Raises unless the run has the files that its manifest lists, of the same sizes."""
    there = data_files(spark, f"{path}/{manifest.run}")
    if there != manifest.files:
        odd = sorted(name for name in there.keys() | manifest.files.keys() if there.get(name) != manifest.files.get(name))
        raise IncompleteDataset(f"{path}: files missing, changed or added: {odd[:5]}")


def prune(spark: SparkSession, path: str, keep: int) -> None:
    """Removes all but the published run, ``keep`` before it and their manifests."""
    kept = {m.run for m in published(spark, path)[: keep + 1]}
    for entry in entries(spark, f"{path}/{FOLDER}"):
        if entry.name.removesuffix(".json") not in kept:
            remove_folder(spark, entry.path)
    for entry in entries(spark, path):
        if entry.name not in {*kept, FOLDER}:
            remove_folder(spark, entry.path)
