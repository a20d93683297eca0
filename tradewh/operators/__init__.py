"""Relational building blocks shared by the plans."""

from tradewh.operators.keys import dense_keys, dense_row_ids, ids_from_tags  # noqa: F401
from tradewh.operators.joins import lookup_join, latest_year  # noqa: F401
from tradewh.operators.windows import with_share, with_rank, running_total, with_lag  # noqa: F401
from tradewh.operators.pivot import pivot, select_existing  # noqa: F401
from tradewh.operators.topk import top_k  # noqa: F401
from tradewh.operators.parallelism import spread  # noqa: F401
from tradewh.operators.distinct import bitmaps, distinct_of, id_blocks, repeated_ids  # noqa: F401
