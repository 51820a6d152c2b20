"""Official-statistics data marts as plain Spark DataFrame jobs."""

__version__ = "0.1.0"
