"""Operators on large text corpora: deduplication, scoring, sampling, encoding, search."""
