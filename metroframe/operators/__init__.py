"""Relational operators: DataFrame in, DataFrame out, no actions."""
