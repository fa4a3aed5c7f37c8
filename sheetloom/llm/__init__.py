"""Operators that prepare training data: near-duplicates, contamination, archives,
chat text, toxicity, licenses, packing, page text and token counts.

Nothing else in the package imports this subpackage.
"""
