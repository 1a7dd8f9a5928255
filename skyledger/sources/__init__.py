"""Scans of the raw inputs and the stored tables with their sinks."""
