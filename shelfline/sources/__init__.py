"""Readers, writers and reference values."""
