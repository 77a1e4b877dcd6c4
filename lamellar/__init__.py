"""Lamellar: a PySpark-native engine for sharded, chunked 3-D label volumes."""

__version__ = "0.1.0"
