"""Spark-native curation of text corpora."""

__version__ = "0.1.0"
