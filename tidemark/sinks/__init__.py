"""Sinks: parquet staging folders, throttled JDBC writes, DDL schemas."""
