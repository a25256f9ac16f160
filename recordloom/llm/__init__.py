"""Operators for training corpora: identification, deduplication, filtering, scanning, tokenising and packing."""
