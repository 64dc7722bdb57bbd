"""Incremental (Structured Streaming) form of the sentiment share reports."""
