"""Structured Streaming versions of ingest, windows, baseline and alerts."""
