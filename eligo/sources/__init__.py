"""Readers: landing windows (JSON), Parquet tables, the state batch log."""
