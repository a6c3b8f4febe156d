"""Analytics engine for document knowledge bases, written for PySpark."""

__version__ = "0.1.0"
