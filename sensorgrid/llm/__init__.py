"""Operators for preparing training text: deduplication, filtering, archives, tokens, shards."""
