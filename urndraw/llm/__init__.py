"""Operators for preparing training text: deduplication, packing, language, personal data, secrets, search."""
