"""Dense surrogate keys without a global single-partition window.

``ROW_NUMBER() OVER (ORDER BY k)`` written as a Spark window with no partition
moves every row into one task. Instead:

1. range-partition on the order columns and sort inside each partition (one
   distributed sort; AQE does not coalesce an explicit partition count);
2. tag each row with ``monotonically_increasing_id()``, whose upper bits are
   the partition index and lower 33 bits the position inside the partition;
3. write that frame as a table in the cluster's checkpoint folder, so both
   uses below read the very same rows and tags (an executor loss cannot
   produce a different layout for one of them; the tags are stored, so the
   file layout on read does not matter);
4. count rows per partition (one row per partition), prefix-sum those counts
   in a tiny window (its size is the partition count) and join them back;
5. key = offset(partition) + position + 1.

For unique order columns this equals ``ROW_NUMBER() OVER (ORDER BY k)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tradewh.operators.materialize import materialize

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def partition_offsets(tagged: DataFrame, tag_col: str) -> DataFrame:
    """``_tw_part``, ``_tw_off``: the rows in the partitions before each one."""
    part = F.shiftright(F.col(tag_col), _POS_BITS)
    counts = tagged.select(part.alias("_tw_part")).groupBy("_tw_part").agg(F.count(F.lit(1)).alias("_tw_n"))
    # One row per partition: the window below runs over the partition count, not the data.
    before = F.sum("_tw_n").over(Window.orderBy("_tw_part").rowsBetween(Window.unboundedPreceding, -1))
    return counts.select("_tw_part", F.coalesce(before, F.lit(0)).alias("_tw_off"))


def ids_from_tags(tagged: DataFrame, tag_col: str, key_col: str, cast: str | None = None,
                  offsets: DataFrame | None = None) -> DataFrame:
    """Replace the stored tag by a dense key 1..n.

    ``tagged`` must be a written table: the tags (``monotonically_increasing_id``
    at the time of writing) are then the same rows' tags wherever they are read,
    whatever partitions, joins or retries lie between. Rows join their
    partition's offset (``offsets``: those of ``partition_offsets``) with a LEFT
    join and a missing offset is an error, so no row can be lost here. Offsets
    are written first: the size of their few rows is then known when the join is
    planned, and the tagged rows need no shuffle for it.
    """
    if offsets is None:
        offsets = materialize(partition_offsets(tagged, tag_col), "offsets")
    part = F.shiftright(F.col(tag_col), _POS_BITS)
    pos = F.col(tag_col).bitwiseAND(F.lit(_POS_MASK))
    missing = F.raise_error(F.lit("a row's partition has no offset: the tagged table changed")).cast("long")
    key = F.coalesce(F.col("_tw_off"), missing) + pos + 1
    if cast:
        key = key.cast(cast)
    out = tagged.join(offsets, part == F.col("_tw_part"), "left")
    return out.select(key.alias(key_col), *[c for c in tagged.columns if c != tag_col])


def dense_keys(df: DataFrame, order_cols: list[str], key_col: str, num_partitions: int | None = None,
               cast: str | None = "int") -> DataFrame:
    """Add ``key_col`` = 1..n following ``order_cols`` (ascending, NULLs first).

    ``order_cols`` should be unique (dimension natural keys are: they come out
    of a DISTINCT or GROUP BY).
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(n, *order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_tw_mid", F.monotonically_increasing_id())
    )
    ranged = materialize(ranged, "keys")
    return ids_from_tags(ranged, "_tw_mid", key_col, cast)


def dense_row_ids(df: DataFrame, key_col: str, cast: str | None = None) -> DataFrame:
    """Add ``key_col`` = 1..n in no particular order (``ROW_NUMBER() OVER ()``).

    No shuffle of the rows: they are tagged, written once, and numbered from
    the written tags.
    """
    tagged = materialize(df.withColumn("_tw_mid", F.monotonically_increasing_id()), "row-ids")
    return ids_from_tags(tagged, "_tw_mid", key_col, cast)
