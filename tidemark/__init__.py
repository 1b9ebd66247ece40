"""Lakehouse analytics jobs written for Spark: DataFrames in, DataFrames out."""

__version__ = "0.1.0"
