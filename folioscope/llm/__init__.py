"""Operators for preparing training text: dedup, quality, extraction, encoding and packing."""
