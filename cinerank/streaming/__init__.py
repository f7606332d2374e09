"""Structured Streaming ingest of ratings files."""
