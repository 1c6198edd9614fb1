"""Folders and files as the session's file system sees them, and small reads from inside tasks."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    is_dir: bool
    size: int


def _file_system(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _file_system(spark, path)
    return fs.exists(place)


def qualified(spark: SparkSession, path: str) -> str:
    """A path written as listings write it."""
    fs, place = _file_system(spark, path)
    return fs.makeQualified(place).toString()


def modified(spark: SparkSession, path: str) -> datetime:
    """When a file was last written."""
    fs, place = _file_system(spark, path)
    return datetime.fromtimestamp(fs.getFileStatus(place).getModificationTime() / 1000, timezone.utc)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, place = _file_system(spark, path)
    fs.delete(place, True)


def move_file(spark: SparkSession, path: str, place: str) -> None:
    """Rename a file; its new folder is made where it is missing."""
    fs, source = _file_system(spark, path)
    target = _file_system(spark, place)[1]
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"could not move {path} to {place}")


def children(spark: SparkSession, path: str) -> list[Entry]:
    """Direct children of a folder in name order."""
    fs, place = _file_system(spark, path)
    found = [
        Entry(s.getPath().toString(), s.getPath().getName(), s.isDirectory(), s.getLen())
        for s in fs.listStatus(place)
    ]
    return sorted(found, key=lambda e: e.name)


def entries(spark: SparkSession, path: str) -> Iterator[Entry]:
    """Direct children of a folder in name order, without hidden and marker files."""
    return (e for e in children(spark, path) if e.name[0] not in "._")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all: written beside, then renamed over what was there."""
    fs, place = _file_system(spark, path)
    beside = _file_system(spark, f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}")[1]
    out = fs.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(place, False)
    if not fs.rename(beside, place):
        raise OSError(f"could not write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    fs, place = _file_system(spark, path)
    stream = fs.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern names, in order."""
    fs, place = _file_system(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(place) or [])


def parquet_files(spark: SparkSession, path: str) -> DataFrame:
    """``path``, ``length``, ``modificationTime`` and ``_metadata`` of all Parquet files below ``path``.

    A listing only: the content column is not selected, so no file is opened.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
        .select("path", "length", "modificationTime", "_metadata")
    )


# Hadoop names of object stores, and the names pyarrow knows them by (fixed values).
ARROW_SCHEMES = {"s3a": "s3", "s3n": "s3", "s3": "s3", "gs": "gs", "hdfs": "hdfs", "abfss": "abfss"}


def arrow_readable(uri: str) -> bool:
    scheme = uri.split(":", 1)[0] if ":" in uri else "file"
    return scheme == "file" or scheme in ARROW_SCHEMES


def arrow_file(uri: str):
    """(pyarrow file system, path) of a file named the way Spark names it; for use inside tasks."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if ":" not in uri:
        return fs.LocalFileSystem(), uri
    scheme, rest = uri.split(":", 1)
    return fs.FileSystem.from_uri(f"{ARROW_SCHEMES.get(scheme, scheme)}:{rest}")
