"""Curated tables and reports, as functions from input tables to result tables."""
