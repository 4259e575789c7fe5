"""Structured Streaming forms of publishing and deduplication."""
