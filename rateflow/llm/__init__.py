"""Operators of a training-data pipeline: deduplication, contamination, language, toxicity, personal data, tokens."""
