"""Structured Streaming forms of the incremental passes."""
