"""Structured Streaming forms of ingest, quality checks and windowed consumption."""
