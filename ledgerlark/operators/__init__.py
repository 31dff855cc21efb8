"""Operators from DataFrames to DataFrames. Column names are always parameters."""
