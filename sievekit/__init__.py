"""Spark-native dataset curation: declarative operators over DataFrames."""

__version__ = "0.1.0"
