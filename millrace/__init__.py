"""Spark-native data-pipeline operators."""

__version__ = "0.1.0"
