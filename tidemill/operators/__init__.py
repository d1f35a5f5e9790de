"""Operators: DataFrames in, DataFrames out; actions only where a docstring says so."""
