"""Parquet sinks: materialised tables and the layered / flat BI exports."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

#: Tables written at a time; Spark's scheduler shares the cluster among their jobs.
TOGETHER = 4


def write_parquet(df: DataFrame, path: str, sort_by: Iterable[str] | None = None,
                  partition_by: Iterable[str] | None = None, range_by: Iterable[str] | None = None) -> str:
    """Overwrite ``path`` with ``df`` as ZSTD Parquet.

    ``sort_by`` sorts rows inside each output file (no shuffle), which keeps the
    Parquet min/max statistics tight for later pushed-down filters — the
    clustering the reference gets from ORDER BY in its CTAS statements.
    ``range_by`` lays the whole table out in that order: files hold ranges that
    don't overlap (one shuffle, for aggregated tables), so a filter on the first
    columns opens a few files only. AQE joins small ranges.
    """
    if range_by:
        df = df.repartitionByRange(*range_by).sortWithinPartitions(*range_by)
    elif sort_by:
        df = df.sortWithinPartitions(*sort_by)
    w = df.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def together(jobs: list[Callable], spark: SparkSession, at_once: int = TOGETHER) -> list:
    """Results of the jobs, some at a time, in their order; the first error is raised."""
    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(lambda job: job(), [inheritable_thread_target(spark)(job) for job in jobs]))


def write_all(tables: dict[str, tuple[DataFrame, str]], range_by: dict[str, list[str]]) -> None:
    """Write each (frame, path), some at a time, laid out by its columns of ``range_by``."""
    jobs = [lambda n=n, df=df, path=path: write_parquet(df, path, range_by=range_by[n]) for n, (df, path) in tables.items()]
    together(jobs, next(iter(tables.values()))[0].sparkSession)


def _export(spark: SparkSession, tables: dict[str, DataFrame], root: str,
            layer: str) -> list[tuple[str, str, int | None, str | None]]:
    """Write each table to ``root/<name>``, some at a time; keep going on errors.

    Returns ``(layer, table, rows, error)`` per table, in the given order; ``rows``
    is counted by the job that writes, so nothing is read back.
    """
    def export(name: str, df: DataFrame) -> tuple[str, str, int | None, str | None]:
        try:
            seen = Observation(f"export-{uuid.uuid4().hex}")
            write_parquet(df.observe(seen, F.count(F.lit(1)).alias("rows")), os.path.join(root, name))
            return layer, name, seen.get["rows"], None
        except Exception as exc:  # noqa: BLE001 - reported per table, like the reference
            return layer, name, None, f"{type(exc).__name__}: {exc}"

    return together([lambda n=n, df=df: export(n, df) for n, df in tables.items()], spark)


def export_layers(spark: SparkSession, dims: dict[str, DataFrame], fact: DataFrame,
                  root: str, fact_name: str = "fact_aduana_item"):
    """Dimensions -> ``root/silver``, fact -> ``root/gold``."""
    res = _export(spark, dims, os.path.join(root, "silver"), "silver")
    res += _export(spark, {fact_name: fact}, os.path.join(root, "gold"), "gold")
    return res


def export_flat(spark: SparkSession, tables: dict[str, DataFrame], root: str):
    """All tables into one folder for BI tools."""
    return _export(spark, tables, root, "flat")
