"""Telemetry anomaly analytics on Spark: label, split, scale, score, evaluate."""
