"""Sensor-observation analytics as Spark DataFrame and Structured Streaming jobs."""
