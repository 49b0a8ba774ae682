"""Operators for building training corpora: packing, dedup, filters, search."""
