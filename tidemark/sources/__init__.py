"""Sources: parquet tables, JDBC query scans, key bounds and chunking."""
