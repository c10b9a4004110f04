"""Incremental rollups with Structured Streaming."""
