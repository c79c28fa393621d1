"""Operators for preparing training text: encoding, deduplication, filtering, packing, formatting."""
