"""Spark-native patent analytics: curated tables, branch classification,
report queries, keyword extraction and streaming upserts."""
