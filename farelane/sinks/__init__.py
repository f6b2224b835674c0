"""Partitioned Parquet sinks."""
