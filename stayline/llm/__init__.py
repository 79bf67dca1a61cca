"""Operators for training-data pipelines: tokens, fingerprints, deduplication, quality, mixing, packing."""
