"""Whole queries composed from operators."""
