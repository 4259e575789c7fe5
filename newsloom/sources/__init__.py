"""Readers and writers of the lake, feeds, pages and tables."""
