"""Incremental ingest of new event files with Structured Streaming."""

from .ingest import ingest_available, read_raw_stream, start_clean_ingest

__all__ = ["ingest_available", "read_raw_stream", "start_clean_ingest"]
