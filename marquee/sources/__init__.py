"""Readers and writers: CSV, XML, JDBC, Parquet tables."""
