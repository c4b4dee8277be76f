"""Readers for raw bulk files, text, nested records and streams."""
