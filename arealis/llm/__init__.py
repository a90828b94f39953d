"""Operators that prepare text corpora for training: sharding, deduplication, fingerprints, mixing, filters, chat."""
