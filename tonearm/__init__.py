"""Listening-history analytics and artist recommendations as Spark jobs."""

__version__ = "0.1.0"
