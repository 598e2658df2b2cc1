"""Incremental tables on Structured Streaming."""
