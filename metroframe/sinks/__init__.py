"""Writers: partitioned Parquet and CSV, catalog loads, partition copies."""
