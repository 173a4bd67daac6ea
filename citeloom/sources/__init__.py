"""Readers: task CSV, answer and summary JSON, JSON lines, package archives, parquet tables."""
