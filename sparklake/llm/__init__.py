"""Operators of a training-data pipeline: mixing, sharding, dedup, quality, PII, tokens."""
