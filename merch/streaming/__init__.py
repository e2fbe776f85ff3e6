"""Structured Streaming forms of the incremental feeds."""
