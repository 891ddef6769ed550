"""ratewise: rating features, scoring and recommendations as Spark DataFrame jobs."""

__version__ = "0.1.0"
