"""Incremental ingest of newly arriving case files with Structured Streaming."""
