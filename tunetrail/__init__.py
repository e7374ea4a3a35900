"""Player-log churn and recommendation analytics on PySpark."""

__version__ = "0.1.0"
