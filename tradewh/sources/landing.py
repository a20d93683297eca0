"""Landing CSV -> bronze Parquet.

Every landing file is read with an explicit all-string schema: the staging
load repairs decimal commas with string functions, so numbers must stay text,
and a fixed schema means no per-file type sniffing pass over the data.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tradewh.schemas import RAW_SCHEMA
from tradewh.sources import folders
from tradewh.sources.csv_split import read_split_csv


class LandingNotFound(FileNotFoundError):
    """Raised when the landing glob matches nothing."""


def read_landing_csv(spark: SparkSession, glob: str, sep: str = ",",
                     encoding: str = "UTF-8", schema=RAW_SCHEMA, escape: str = '"',
                     multi_line: bool = True, split: bool | None = None) -> DataFrame:
    """All CSV files of the landing zone as one relation.

    Quoted fields may hold line breaks. Spark's own reader then reads each file in
    one task; ``split`` reads files in many tasks each (``csv_split``), with the
    same rows. By default it does where a file is larger than a split and quotes
    are doubled. ``multi_line=False`` says that no field holds a line break.

    ``enforceSchema=False`` makes Spark check each file's header against the
    schema, so a file with renamed or reordered columns fails loudly instead
    of shifting values into the wrong columns.
    """
    if multi_line and split is None:
        split = escape == '"' and folders.largest(spark, glob) > _split_bytes(spark)
    if multi_line and split:
        return read_split_csv(spark, glob, sep, encoding, schema)
    try:
        return (
            spark.read.option("header", True)
            .option("enforceSchema", False)
            .option("sep", sep)
            .option("encoding", encoding)
            .option("escape", escape)
            .option("multiLine", multi_line)
            .option("mode", "FAILFAST")
            .schema(schema)
            .csv(glob)
        )
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        raise LandingNotFound(f"landing files not found: {glob}") from exc


def _split_bytes(spark: SparkSession) -> int:
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    n, unit = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)i?b?\s*", size.lower()).groups()
    return int(n) << 10 * " kmgtp".index(unit or " ")


def write_bronze(df: DataFrame, path: str) -> str:
    """Replace the bronze snapshot with ``df`` (ZSTD Parquet)."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return path


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    """Bronze snapshot scan (S3); pruning and pushdown come with Parquet."""
    return spark.read.parquet(path)


def write_landing_csv(df: DataFrame, path: str, sep: str = ",", escape: str = '"') -> str:
    """Write ``df`` as landing CSV files (header, values kept verbatim —
    leading/trailing blanks included)."""
    (df.write.mode("overwrite").option("header", True).option("sep", sep).option("escape", escape)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    return path
