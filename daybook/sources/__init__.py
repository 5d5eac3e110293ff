"""Readers and writers of the four layers (Bronze CSV, Silver/Gold/mart Parquet, JDBC)."""
