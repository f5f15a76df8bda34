"""Measurement-lake engine: landing, trusted and delivery tables as Spark DataFrame jobs."""

__version__ = "0.1.0"
