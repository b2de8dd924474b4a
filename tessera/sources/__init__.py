"""Scans: driver parquet tables, tolerant CSV, text, JSON, binary files."""
