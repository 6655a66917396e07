"""Incremental forms of the steps on Structured Streaming."""
