"""Incremental forms of the batch jobs as Structured Streaming queries."""
