"""Operators for training-data pipelines: packing, secrets, deduplication, extraction, search, archives, toxicity."""
