"""Operators that prepare text corpora for training: formats, filters, deduplication, packing."""
