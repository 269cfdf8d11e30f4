"""Structured Streaming: change-stream ingest, dedupe, windows, late rows."""
