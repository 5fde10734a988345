"""Marts and jobs composed from the operators."""
