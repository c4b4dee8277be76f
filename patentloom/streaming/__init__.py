"""Structured Streaming queries that keep report tables current."""
