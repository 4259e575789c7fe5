"""Batch and streaming jobs for a news-article lake, written for Apache Spark."""
