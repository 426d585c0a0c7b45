"""Incremental raw / trusted / star-schema / mart processing on PySpark."""

__version__ = "0.1.0"
