"""Star-schema ETL and analytics as DataFrame operations on Spark."""

__version__ = "0.1.0"
