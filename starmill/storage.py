"""Files of any store that Spark's own file systems reach, as the driver sees them."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    is_folder: bool
    size: int

    @property
    def hidden(self) -> bool:
        return self.name.startswith(("_", "."))


def _file_system(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _file_system(spark, path)
    return fs.exists(folder)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, folder = _file_system(spark, path)
    return fs.exists(folder) and fs.getFileStatus(folder).isDirectory()


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """What is directly below a folder, by name; nothing if the folder is not there."""
    fs, folder = _file_system(spark, path)
    if not fs.exists(folder):
        return []
    found = [
        Entry(s.getPath().toString(), s.getPath().getName(), s.isDirectory(), s.getLen()) for s in fs.listStatus(folder)
    ]
    return sorted(found, key=lambda x: x.name)


def data_files_of(spark: SparkSession, path: str) -> list[str]:
    """Paths of all files below a folder, at any depth, but for hidden ones."""
    found, todo = [], [path]
    while todo:
        for entry in entries(spark, todo.pop()):
            if not entry.hidden:
                (todo if entry.is_folder else found).append(entry.path)
    return sorted(found)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, folder = _file_system(spark, path)
    fs.delete(folder, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, file = _file_system(spark, path)
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all: written beside, then renamed."""
    fs, file = _file_system(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(file.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(beside, file):
        fs.delete(beside, False)
        raise OSError(f"{path} is there already or cannot be written")


# A table is written several times a day: zstd takes fewer bytes than snappy, and numbers in order or in a narrow range are
# few bits each in the second version of Parquet's pages.
PACKED = {
    "compression": "zstd",
    "parquet.compression.codec.zstd.level": "9",
    "parquet.writer.version": "PARQUET_2_0",
}


def packed(fmt: str) -> dict[str, str]:
    """How files of a format are packed."""
    return PACKED if fmt == "parquet" else {}


def version() -> str:
    """A new name that sorts behind those made before."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
