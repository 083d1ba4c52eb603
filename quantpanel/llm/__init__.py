"""Operators for preparing training text: counting, packing, deduplication, scanning, scoring."""
