"""Operators that prepare training data: search, packing, filters, dedup, mixing, scoring."""
