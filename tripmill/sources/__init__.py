"""Reads and writes: parquet, JDBC, the dimensions and stored models."""
