"""Incremental (Structured Streaming) versions of the pipeline steps."""
