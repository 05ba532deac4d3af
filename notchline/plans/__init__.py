"""Keyed queries over the stand-in tables and their SQL oracles.

Importing this package registers every query in ``registry.QUERIES`` and its
oracle in ``registry.ORACLE``.
"""

from notchline.plans import (  # noqa: F401
    gate_queries,
    history_queries,
    ingest_queries,
    matching_queries,
    pattern_queries,
    sink_queries,
)
from notchline.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
