"""Structured Streaming forms of ingest and upsert."""
