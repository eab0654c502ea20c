"""Operators for building training data from large corpora: filters, near-duplicates, tokens, packing, archives."""
