"""Spark-native analytics over longitudinal entity metrics."""

__version__ = "0.1.0"
