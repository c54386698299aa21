"""Streams: incremental ingest and windowed events."""
