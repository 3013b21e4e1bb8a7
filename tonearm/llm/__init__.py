"""Operators for training-data pipelines: dedup, scoring, counting, mixing and search over documents."""
