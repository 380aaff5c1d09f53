"""Column-level helpers (no DataFrame in, no DataFrame out)."""
