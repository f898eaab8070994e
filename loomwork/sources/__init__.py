"""Readers, writers and the tables derived from the base tables."""
