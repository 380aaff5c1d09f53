"""Readers, writers and the stand-in fixtures built from the driver tables."""
