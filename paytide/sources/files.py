"""Folders of a table, through the file system the session uses for their path."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def _opened(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _opened(spark, path)
    return system.exists(target)


def subfolders(spark: SparkSession, path: str, key: str) -> dict[str, str]:
    """Paths of the folders `key=value` right below `path`, by value."""
    system, target = _opened(spark, path)
    if not system.exists(target):
        return {}
    found = {}
    for status in system.listStatus(target):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(f"{key}="):
            found[name[len(key) + 1 :]] = status.getPath().toString()
    return found


def data_files(spark: SparkSession, path: str) -> list[str]:
    """All Parquet files below `path`, less those that Spark's readers skip."""
    system, target = _opened(spark, path)
    found, files = [], system.listFiles(target, True)
    root = system.makeQualified(target).toString()
    while files.hasNext():
        file = files.next().getPath().toString()
        below = file[len(root) :].strip("/").split("/")
        hidden = any(part.startswith((".", "_")) for part in below)
        if file.endswith(".parquet") and not hidden:
            found.append(file)
    return sorted(found)


def remove(spark: SparkSession, paths: Iterable[str]) -> None:
    """Delete folders with all they hold; missing ones do no harm."""
    for path in paths:
        system, target = _opened(spark, path)
        system.delete(target, True)
