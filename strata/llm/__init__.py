"""Operators for preparing training text: formatting, deduplication, archives, counting, packing, search."""
