"""Operators: DataFrames and parameters in, a DataFrame out."""
