"""Operators: each a function from DataFrames to one DataFrame."""
