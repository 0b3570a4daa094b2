"""Operators for training-data pipelines: deduplication, scoring, filters and tokens."""
