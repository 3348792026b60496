"""Operators for preparing training text: filters, deduplication, packing, token counts.

Nothing else in the library imports this subpackage.
"""
