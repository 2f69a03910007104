"""Operators: DataFrames in, DataFrames out, no actions unless the docstring says so."""
