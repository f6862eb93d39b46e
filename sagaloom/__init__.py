"""Sagaloom: a Spark-native analytics engine for timestamped, multi-source narrative data."""

__version__ = "0.1.0"
