"""Operators for corpora of training documents: cleaning, deduplication, mixing, tokens."""
