"""Incremental ingest and change-feed apply with Structured Streaming."""
