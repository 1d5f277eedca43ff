"""Structured Streaming ingest: pushes, seen updates, windowed counts, new posts."""
