"""Spark jobs that build, check, review and score retrieval-evaluation data."""

__version__ = "0.1.0"
