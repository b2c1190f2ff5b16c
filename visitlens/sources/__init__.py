"""Readers (parquet / table / JDBC / stream) and writers for the analytics."""
