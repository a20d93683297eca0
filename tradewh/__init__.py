"""tradewh — a Spark-native star-schema warehouse for customs declarations.

Layers (each a plain DataFrame function; nothing leaves Spark until a report is
collected by its caller):

* ``sources``   — landing CSV, bronze Parquet, fixture adapter, Parquet sinks
* ``functions`` — Column -> Column normalisers (text, numbers, dates, channel)
* ``operators`` — reusable relational building blocks (dense keys, lookup and
  star joins, shares, ranks, pivots, top-k)
* ``plans``     — the named deliverables: staging, dimensions, fact, marts,
  views, reports, chart datasets, quality checks, warehouse load
"""

__version__ = "0.1.0"
