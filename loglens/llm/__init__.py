"""Operators for training-data pipelines (quality, extraction, dedup, mixing,
tokenising, sharding).  Nothing else in the library imports this subpackage."""
