"""Operators of a training-data pipeline: near-duplicates, mixing, quality, tokens, language models."""
