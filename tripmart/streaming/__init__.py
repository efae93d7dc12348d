"""Structured Streaming: file ingest once per file, and incremental fact loading."""
