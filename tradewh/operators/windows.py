"""Window helpers over already-aggregated frames.

All are meant to run *after* a groupBy, on frames whose size is bounded by the
number of groups; the partition keys keep each window task small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradewh.functions.numeric import round_half_away


def with_share(df: DataFrame, value: str, partition: list[str], name: str, digits: int) -> DataFrame:
    """``ROUND(value * 100 / SUM(value) OVER (PARTITION BY partition), digits)``.

    Sums run on the exact (DECIMAL/BIGINT) values; the ratio is DOUBLE.
    """
    w = Window.partitionBy(*partition)
    ratio = F.col(value).cast("double") * 100.0 / F.sum(value).over(w).cast("double")
    return df.withColumn(name, round_half_away(ratio, digits))


def with_rank(df: DataFrame, value: str, partition: list[str], name: str) -> DataFrame:
    """``RANK() OVER (PARTITION BY partition ORDER BY value DESC)``."""
    w = Window.partitionBy(*partition).orderBy(F.col(value).desc_nulls_last())
    return df.withColumn(name, F.rank().over(w))


def with_lag(df: DataFrame, value: str, partition: list[str], order: list[str], name: str) -> DataFrame:
    """``LAG(value) OVER (PARTITION BY partition ORDER BY order)``."""
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn(name, F.lag(value).over(w))


def running_total(df: DataFrame, value: str, partition: list[str], order: list[str], name: str) -> DataFrame:
    """``SUM(value) OVER (... ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)``."""
    w = Window.partitionBy(*partition).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(name, F.sum(value).over(w))


def asc_nulls_last(*cols: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in cols]
