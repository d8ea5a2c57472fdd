"""Continuous forms of the ingest and monitoring jobs (Structured Streaming)."""
