"""Spark-native record linkage, geospatial matching and reporting over DataFrames."""

__version__ = "0.1.0"
