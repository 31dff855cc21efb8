"""Tabular analytics and model-pipeline operators for Spark DataFrames."""

__version__ = "0.1.0"
