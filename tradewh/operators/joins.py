"""Joins of the star schema.

No join strategy is forced: Spark broadcasts a dimension when its size in bytes
is under ``spark.sql.autoBroadcastJoinThreshold`` (AQE also when the measured
shuffle output is), else it shuffles both sides, and AQE splits the partitions
of hot keys (NULL natural keys among them, all on the fact side of a LEFT
join). Rows and results are the same either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def lookup_join(left: DataFrame, dim: DataFrame, left_key: str, dim_key: str,
                take: list[str], how: str = "left") -> DataFrame:
    """Surrogate-key lookup: ``left`` LEFT JOIN ``dim`` on natural key.

    Row count of ``left`` is preserved because ``dim_key`` is unique in ``dim``.
    """
    d = dim.select(F.col(dim_key).alias("_lk_key"), *take)
    return left.join(d, left[left_key] == d["_lk_key"], how).drop("_lk_key")


def latest_year(df: DataFrame, year_col: str = "anio") -> DataFrame:
    """Keep the rows of the latest year present in ``df``.

    An equi-join to a one-row aggregate: the broadcast side has exactly one row.
    """
    top = df.agg(F.max(year_col).alias("_ly_year"))
    return df.join(F.broadcast(top), F.col(year_col) == F.col("_ly_year")).drop("_ly_year")
