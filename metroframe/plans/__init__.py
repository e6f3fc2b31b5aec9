"""Composed tables: each is a function from input DataFrames to one DataFrame."""
