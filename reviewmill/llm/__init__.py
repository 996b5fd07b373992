"""Operators for preparing training text: extraction, quality, deduplication, mixing and encoding."""
