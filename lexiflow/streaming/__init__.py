"""Structured Streaming forms of the run-metric log."""
