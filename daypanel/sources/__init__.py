"""Readers, writers, shared scratch space and the panels derived from the given tables."""
