"""Inputs: NDJSON and CSV files, staged Parquet tables, JDBC tables."""
