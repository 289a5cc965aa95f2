"""Operators of a training-data pipeline: text in, decisions, fingerprints, tokens and files out."""
