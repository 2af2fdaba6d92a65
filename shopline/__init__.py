"""shopline — retail sales analytics as Spark DataFrame operators.

Layout
------
``sources``    CSV (with double-encoded line repair), Parquet, role tables
``functions``  column-level helpers: exact money sums, null-safe correlation,
               calendar keys, size-checked broadcast
``operators``  profiling, cleaning, consolidation joins, analytic aggregates
``plans``      the thirteen marts, the whole batch run, the query catalog
``sinks``      Parquet, JDBC and audit-JSON writers
``streaming``  (the batch reference has no streaming operators; see README)
"""

__all__ = ["session"]
