"""Operators for preparing training data: dedup, tokens, language, secrets, packing."""
