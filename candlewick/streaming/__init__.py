"""Structured Streaming forms of the ingest stage."""
