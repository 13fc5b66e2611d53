"""Operators for preparing training data: filters, near duplicates, mixing, tokens."""
