"""notchline: inspection-file analytics as Spark DataFrame jobs.

Sub-packages:
  sources    readers for the nested file envelope, lookup CSVs, parameter sets
  functions  column-expression helpers (splitting, rendering, geometry)
  operators  the relational building blocks (gates, band join, as-of, patterns, sinks)
  plans      the keyed queries over the stand-in tables and their SQL oracles
  streaming  incremental ingestion of a file directory with Structured Streaming
"""

__all__ = ["session", "constants"]
