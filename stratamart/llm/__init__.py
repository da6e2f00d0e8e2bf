"""Operators for preparing training text: deduplication, filtering, mixing and packing."""
