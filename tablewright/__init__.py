"""Spark-native preparation and diagnostics of tabular data for regression.

Every operator is a function from DataFrames to DataFrames. Statistics that are
fitted on one table and applied to another come back as small parameter objects.
"""

__version__ = "0.1.0"
