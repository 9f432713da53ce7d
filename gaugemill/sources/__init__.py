"""Scans, sinks, dimensions, generators and schema contracts."""
