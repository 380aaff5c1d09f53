"""Operators for large-scale training-data pipelines (dedup, scans, search, tokens, extraction)."""
