"""Structured Streaming jobs (incremental bronze landing)."""
