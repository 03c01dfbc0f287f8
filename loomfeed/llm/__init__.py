"""Operators for training data: scoring, dedup, cleaning, search, packing, sharding, archives."""
