"""Operators of a large-scale training-data pipeline: filtering, deduplication, sharding, tokens, archives."""
