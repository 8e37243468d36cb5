"""Incremental loads by Structured Streaming."""
