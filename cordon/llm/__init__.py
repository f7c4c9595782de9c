"""Operators for preparing training text: packing, quality, deduplication, mixing, personal data,
url rules, near-duplicate joins and token counts. Nothing else in the library imports this package."""
