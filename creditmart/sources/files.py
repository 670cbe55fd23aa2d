"""Listing, moving and removing paths on whatever file system Spark uses."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Part:
    """One file of an extract or table: its path, and the same as Spark names it in ``input_file_name``."""

    path: str
    uri: str
    size: int
    modified: int


def _located(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    file_system, location = _located(spark, path)
    return file_system.exists(location)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, sorted."""
    file_system, location = _located(spark, pattern)
    return sorted(status.getPath().toString() for status in file_system.globStatus(location) or [])


def parts(spark: SparkSession, path: str) -> list[Part]:
    """The files of an extract or table, those that Spark would read, by path."""
    file_system, location = _located(spark, path)
    found, statuses = [], file_system.listFiles(location, True)
    while statuses.hasNext():
        status = statuses.next()
        if not status.getPath().getName().startswith(("_", ".")):
            at = status.getPath()
            found.append(Part(at.toString(), at.toUri().toString(), status.getLen(), status.getModificationTime()))
    return sorted(found, key=lambda part: part.path)


def make_folder(spark: SparkSession, path: str) -> None:
    file_system, location = _located(spark, path)
    file_system.mkdirs(location)


def remove(spark: SparkSession, path: str) -> None:
    file_system, location = _located(spark, path)
    file_system.delete(location, True)


def rename(spark: SparkSession, path: str, target: str) -> None:
    """Move a file or folder in one step; nothing may be at the target."""
    file_system, location = _located(spark, path)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    file_system.mkdirs(to.getParent())
    if file_system.exists(to) or not file_system.rename(location, to):
        raise OSError(f"cannot move {path} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all."""
    file_system, location = _located(spark, f"{path}.part")
    out = file_system.create(location, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename(spark, f"{path}.part", path)


def read_text(spark: SparkSession, path: str) -> str:
    file_system, location = _located(spark, path)
    stream = file_system.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
