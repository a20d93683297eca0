"""Wide projections as methods that the JVM compiles.

Whole-stage code generation puts a projection of fifty typed columns into one Java
method of some 30 kB of bytecode. HotSpot compiles none above 8,000 bytes, so such
a method stays interpreted for every row. ``spark.sql.codegen.hugeMethodLimit`` at
8,000 (what Spark's documentation advises on HotSpot) makes Spark run a stage of
that kind operator by operator, its expressions split into small methods.

A projection of as many columns on top of joins can lie just below that limit (the
raw extract: 7,918 bytes) and is found interpreted all the same.
``spark.sql.codegen.maxFields`` at 40 takes frames that wide out of whole-stage code:
the joins below keep theirs, the projection is split into small methods.
"""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

LIMIT = "spark.sql.codegen.hugeMethodLimit"
FIELDS = "spark.sql.codegen.maxFields"
#: HotSpot's ``HugeMethodLimit`` in bytes of bytecode.
HOTSPOT = 8000
#: Columns of a frame up to which its operators go into whole-stage code.
NARROW = 40
_MOST = {LIMIT: HOTSPOT, FIELDS: NARROW}

_lock = threading.Lock()
_users, _before = 0, {}


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Jobs started meanwhile run no generated method that the JVM leaves interpreted;
    the session's settings are put back when the last user is through."""
    global _users, _before
    with _lock:
        if _users == 0:
            _before = {name: spark.conf.get(name) for name in _MOST}
            for name, most in _MOST.items():
                spark.conf.set(name, str(min(int(_before[name]), most)))
        _users += 1
    try:
        yield
    finally:
        with _lock:
            _users -= 1
            if _users == 0:
                for name, value in _before.items():
                    spark.conf.set(name, value)
