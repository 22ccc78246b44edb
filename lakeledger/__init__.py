"""lakeledger: change feeds to history on Spark.

Layers:
  sources    page files, JSON-lines logs, table reads
  functions  scalar column expressions (no Python UDFs)
  operators  bronze (event log), silver (SCD2 history), views, quality,
             audit, export
  streaming  Structured Streaming entry points
  plans      adapters from the given tables and the registered queries
"""

from lakeledger.operators.silver import Scd2Spec, build_scd2  # noqa: F401

__all__ = ["Scd2Spec", "build_scd2"]
