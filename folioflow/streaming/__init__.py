"""Structured Streaming forms of the incremental stages."""
