"""Folders of the shared store, through Spark's own file systems."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> dict[str, int]:
    """Name -> time of last change (ms) of what lies in a folder; none if it is missing."""
    fs, p = _at(spark, path)
    return {s.getPath().getName(): s.getModificationTime() for s in fs.listStatus(p)} if fs.exists(p) else {}


def last_change(spark: SparkSession, path: str) -> int:
    """Time (ms) of the last change in a folder or its direct children."""
    fs, p = _at(spark, path)
    return max([fs.getFileStatus(p).getModificationTime(), *children(spark, path).values()])


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    fs, p = _at(spark, path)
    fs.create(p, True).close()


def largest(spark: SparkSession, glob: str | list[str]) -> int:
    """Bytes of the largest file that a glob (or a list of them) matches, directly or in a folder."""
    most = 0
    for one in [glob] if isinstance(glob, str) else glob:
        fs, p = _at(spark, one)
        for status in fs.globStatus(p) or []:
            for s in fs.listStatus(status.getPath()) if status.isDirectory() else [status]:
                most = max(most, s.getLen())
    return most


def rounds(df: DataFrame, most: int) -> list[DataFrame]:
    """A frame that reads files, as frames over some of the files each: so many bytes
    at most, or one file. A frame that reads no files is one round.

    The last round has the files that no other one names, so that no row can be lost.
    """
    if not df.inputFiles():
        return [df]
    groups, room = [], 0
    for path, size in sorted(df.select("_metadata.file_path", "_metadata.file_size").distinct().collect()):  # a row per file
        if not groups or size > room:
            groups.append([])
            room = most
        groups[-1].append(path)
        room -= size
    if len(groups) < 2:
        return [df]
    file = F.col("_metadata.file_path")
    others = [path for group in groups[:-1] for path in group]
    return [*(df.where(file.isin(group)) for group in groups[:-1]), df.where(~file.isin(others))]
