"""Shuffle files that go with the job that wrote them.

Spark keeps a shuffle's files until the JVM collects the plan that refers to them,
which in a long load is after its end: the files of every step lie on disk at
once. ``spark.sql.classic.shuffleDependency.fileCleanup.enabled`` removes them when
the job ends. Each step of a load is one write, whose plan no later job runs again;
later steps read the written table.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_lock = threading.Lock()
_users, _before = 0, None


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of jobs started meanwhile are removed at each job's end; the
    session's setting is put back when the last user is through."""
    global _users, _before
    with _lock:
        if _users == 0:
            _before = spark.conf.get(CLEANUP)
            spark.conf.set(CLEANUP, "true")
        _users += 1
    try:
        yield
    finally:
        with _lock:
            _users -= 1
            if _users == 0:
                spark.conf.set(CLEANUP, _before)
