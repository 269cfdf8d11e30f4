"""Batch table writers."""
