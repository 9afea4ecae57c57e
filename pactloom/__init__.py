"""Contract-driven data pipelines as plain Spark DataFrame, SQL and streaming jobs."""

__version__ = "0.1.0"
