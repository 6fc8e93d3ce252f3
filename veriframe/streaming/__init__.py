"""Continuous scans and measurements with Structured Streaming."""
