"""Counting distinct dense integer keys by bitmaps.

Surrogate keys and row ids are dense, so a set of them is a bitmap. Bitmaps of
finer groups join to those of coarser ones by OR, which counts of distinct values
don't: a stored table of them answers distinct counts at every level above it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradewh.operators.materialize import materialize


def bitmaps(df: DataFrame, keys: list[str], value: str, *more) -> DataFrame:
    """Per group of ``keys`` and bucket of 32,768 values: ``bucket``, ``bits`` of the
    distinct values, and the aggregates ``more`` (sums, named) over its rows.

    Rows are first grouped with the value (a hash aggregate, partial in the scan
    tasks; the bitmap aggregate is none), so a bitmap is built of a row per value.
    NULL values form a bucket without bits.
    """
    bits = F.bitmap_construct_agg(F.bitmap_bit_position(value)).alias("bits")
    first = df.groupBy(*keys, value).agg(*more) if more else df.select(*keys, value).distinct()
    names = [c for c in first.columns if c not in (*keys, value)]
    return first.groupBy(*keys, F.bitmap_bucket_number(value).alias("bucket")).agg(bits, *[F.sum(c).alias(c) for c in names])


def distinct_of(maps: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Distinct values per group of ``keys``, coarser than or equal to those of ``maps``."""
    joined = maps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return joined.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias(name))


def id_blocks(df: DataFrame, key: str) -> DataFrame:
    """Per block of 64 ids: ``block``, ``bits`` (a BIGINT, ids that occur), ``rows``,
    ``least`` and ``most``.

    Neighbouring ids lie in the same task mostly, where their block is made one row:
    what is shuffled are blocks, not ids.
    """
    return df.groupBy(F.shiftright(key, 6).alias("block")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST({key} & 63 AS INT))")).alias("bits"), F.count(F.lit(1)).alias("rows"),
        F.min(key).alias("least"), F.max(key).alias("most"))


def repeated_ids(df: DataFrame, key: str) -> DataFrame:
    """One row ``duplicate_keys``: values of a dense id that occur more than once.

    Blocks with more rows than bits hold them; only the rows of such blocks, if
    there are any, are grouped by their ids.
    """
    blocks = id_blocks(df, key)
    wrong = materialize(blocks.where(F.coalesce(F.bit_count("bits"), F.lit(1)) < F.col("rows")).select(F.col("block").alias("_block")), "id-blocks")
    if wrong.isEmpty():
        return df.sparkSession.range(1).select(F.lit(0).cast("long").alias("duplicate_keys"))
    rows = df.select(key).join(wrong, F.shiftright(key, 6).eqNullSafe(F.col("_block")), "left_semi")
    return rows.groupBy(key).count().where("count > 1").agg(F.count(F.lit(1)).alias("duplicate_keys"))
