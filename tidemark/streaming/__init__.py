"""Structured Streaming jobs: keyed feature windows, alerts, scoring, hourly view."""
