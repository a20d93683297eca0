"""Cut lineage by writing a table to the cluster's shared checkpoint folder.

``Dataset.checkpoint()`` runs its job and then computes the data a second time
to write the checkpoint files (unless it is also cached). Writing Parquet
computes it once, is columnar, and survives executor loss the same way. The
folder is the one the session names in ``spark.checkpoint.dir``.

Tables written inside ``scratch(spark)`` are removed at its end; others stay
for as long as whoever reads the returned frames needs them, and go with the
folder.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tradewh.session import ensure_checkpoint_dir

_local = threading.local()


def materialize(df: DataFrame, label: str = "tmp") -> DataFrame:
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tradewh-{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    if getattr(_local, "scratch", None) is not None:
        _local.scratch.append(path)
    return spark.read.parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end, the tables that ``materialize`` writes meanwhile;
    whatever reads them must have run by then."""
    outer, _local.scratch = getattr(_local, "scratch", None), []
    try:
        yield
    finally:
        written, _local.scratch = _local.scratch, outer
        for p in written:
            path = spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
