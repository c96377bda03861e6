"""Operators that prepare training text: extraction, filters, near duplicates, tokens, packing, shards."""
