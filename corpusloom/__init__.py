"""A Spark-native engine for building, governing and searching text corpora."""

__version__ = "0.1.0"
