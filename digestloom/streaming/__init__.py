"""Incremental runs as Structured Streaming jobs."""
