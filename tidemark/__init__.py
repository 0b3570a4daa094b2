"""Telemetry feature, anomaly and model-monitoring analytics as Spark jobs."""
