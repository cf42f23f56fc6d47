"""Structured Streaming jobs: layered tables, counters, windows, de-duplication."""
