"""metroframe: city open-data batch analytics expressed as Spark DataFrame jobs.

Operators take DataFrames and column names and return DataFrames; only the
sinks and the streaming ingest start actions of their own.
"""

__version__ = "0.1.0"
