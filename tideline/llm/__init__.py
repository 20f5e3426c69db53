"""Operators of a training-data pipeline: mixing, packing, deduplication, classifiers, scoring."""
