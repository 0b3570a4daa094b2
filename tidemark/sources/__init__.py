"""Readers and writers for telemetry, features, manifests, summaries and run history."""
