"""Sources and sinks: landing CSV, bronze Parquet, fixture adapter, exports."""

from tradewh.sources.landing import read_landing_csv, write_bronze, read_bronze  # noqa: F401
from tradewh.sources.fixtures import raw_items, read_table  # noqa: F401
from tradewh.sources.sinks import write_parquet, export_layers, export_flat  # noqa: F401
