"""Scans and sinks: Parquet, CSV with a schema beside it, JDBC, warehouses, scratch tables."""
