"""matchloom: sports-league analytics expressed as PySpark DataFrame operations."""

__version__ = "0.1.0"
