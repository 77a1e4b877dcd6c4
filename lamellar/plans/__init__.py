"""Registered queries of the engine and the SQL that states the same results."""

from . import source_queries as _source_queries  # noqa: F401  registers its queries
from .registry import ORACLES, QUERIES, flagship

__all__ = ["ORACLES", "QUERIES", "flagship"]
