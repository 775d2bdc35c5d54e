"""Scans, sinks and generated tables."""
