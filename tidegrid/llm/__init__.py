"""Operators for training-data pipelines: deduplication, scoring, filtering, mixing, formatting and packing of texts."""
