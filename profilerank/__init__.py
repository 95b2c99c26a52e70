"""Profile-pool features, integrity checks and ranking as PySpark DataFrame operators."""

__version__ = "0.1.0"
