"""Operators for building training corpora: filters, near-duplicates, scores, packing and shards."""
