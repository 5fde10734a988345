"""Readers: driver tables, fixture views derived from them, tabular files."""
