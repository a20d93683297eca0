"""Namespaces ``dw`` and ``analytic`` of the catalog, with named tables, views
and functions (S10, S11).

The tables are external: they name the folders of one snapshot, so dropping
them drops no data, and registering another snapshot re-points them. Views and
functions are text in the catalog and follow the tables.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tradewh.functions.catalog import register_functions
from tradewh.plans import marts
from tradewh.plans.view_sql import register_catalog_views
from tradewh.plans.warehouse import DIM_NAMES, FACT, STAGING, Warehouse


def ensure_schemas(spark: SparkSession) -> None:
    for name in ("dw", "analytic"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def register_tables(spark: SparkSession, wh: Warehouse, with_marts: bool = True) -> list[str]:
    """Name the snapshot's tables: ``dw.*``, and ``analytic.*`` for the marts; with
    them the SQL functions of ``dw`` and the six views of ``analytic``."""
    ensure_schemas(spark)
    names = {f"dw.{n}": wh.path(n) for n in [STAGING, *DIM_NAMES, FACT]}
    if with_marts:
        for n in marts.KEY_GRAINS:
            names[f"analytic.{n}"] = wh.mart_path(n)  # written on first use
    for name, path in names.items():
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=path, source="parquet")
        if name == f"dw.{FACT}":
            spark.catalog.recoverPartitions(name)
    return [*names, *register_functions(spark), *register_catalog_views(spark)]
