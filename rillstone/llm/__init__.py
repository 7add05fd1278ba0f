"""Operators for preparing training data: search, packing, deduplication, filtering, tokens, shards."""
