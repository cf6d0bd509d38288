"""Operators: DataFrames and scalars in, DataFrames out, nothing executed."""
