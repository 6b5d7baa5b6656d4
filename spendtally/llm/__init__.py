"""Operators for preparing training data: sharding, deduplication, scoring, sanitising and mixing."""
