"""Operators of a training-data pipeline: scoring, deduplication, mixing,
packing, search and archives over document tables."""
