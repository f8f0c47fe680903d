"""Operators for preparing training data: near duplicates, search, tokens, personal data, scoring, sharding, packing."""
