"""Result preview (S12): the first rows of a report, whether there are more,
and an empty-result flag — without counting or fetching the whole result."""

from __future__ import annotations

from pyspark.sql import DataFrame


def preview(df: DataFrame, limit: int = 15) -> dict:
    """Fetch at most ``limit + 1`` rows (a LIMIT, not a collect of the result)."""
    rows = df.limit(limit + 1).collect()
    return {
        "columns": df.columns,
        "rows": rows[:limit],
        "truncated": len(rows) > limit,
        "empty": not rows,
    }
