"""Sensor-telemetry analytics as plain PySpark DataFrame operators."""
