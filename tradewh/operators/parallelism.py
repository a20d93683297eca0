"""Keep under-split sources from serialising a whole pipeline.

A source with fewer input splits than the cluster has cores (one big
unsplittable file, a single Parquet row group, a gzip CSV) would run every
narrow step after it — parsing, lookups, writes — in that many tasks only,
and the files it writes inherit the same layout. ``spread`` adds one
round-robin shuffle in exactly that case and is a no-op otherwise, so a
well-split 100 TB input is not shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

#: A shuffle or broadcast as a node of a plan's tree (not a word in a path or column).
_EXCHANGE = re.compile(r"(?m)^[\s:+\-]*(?:\*\(\d+\) )?(?:Broadcast)?Exchange\b")


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """``df`` in at least ``min_partitions`` (default: the cluster's cores) tasks.

    Looks at scans and narrow steps only: behind a shuffle AQE sizes the
    partitions itself, and counting them would run that shuffle.
    """
    spark = df.sparkSession
    if _EXCHANGE.search(df._jdf.queryExecution().executedPlan().toString()):
        return df
    target = min_partitions or spark.sparkContext.defaultParallelism
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
