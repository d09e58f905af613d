"""Operators of a training-data pipeline: rules, archives, deduplication, formatting, filters, tokens."""
