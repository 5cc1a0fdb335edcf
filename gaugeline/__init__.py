"""Sensor-telemetry analytics as plain Spark DataFrame functions."""
