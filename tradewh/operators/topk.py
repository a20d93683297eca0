"""Top-k (O4, O6): ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject —
each task keeps its own k best rows and only those reach the final merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    return df.orderBy(*order).limit(k)
