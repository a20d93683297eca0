"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradewh.session import ensure_checkpoint_dir


def let_workers_import(spark: SparkSession) -> None:
    """Python workers look for this package where the driver found it (beside
    wherever else they look: on a cluster it is installed)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (path, root) if x)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    let_workers_import(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder below the shared one the session names, as a URI."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if "://" not in base and not base.startswith("file:"):
        base = f"file://{base}"
    return f"{base}/tradewh-{label}-{uuid.uuid4().hex}"


def store(uri: str):
    """(filesystem, path) of a URI; works in tasks and on the driver, for any
    store that Arrow's file systems reach (local, HDFS, S3, GCS)."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def in_fold(id_col: str, modulus: int, remainder: int) -> Column:
    """True where crc32 of the id as text leaves ``remainder``; false for null ids."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % modulus == remainder, F.lit(False))


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, cast: ``pick(docs, doc_id="long", text="string")``.

    Whatever else the table holds can then not clash with an operator's names.
    """
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c) for c, t in cols.items()])
