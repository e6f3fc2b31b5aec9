"""Readers: CSV, XML, Parquet, latest snapshot, catalog tables."""
