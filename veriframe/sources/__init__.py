"""Containers: discovery, readers, bounds, sampling and sinks."""
