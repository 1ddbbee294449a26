"""Operators for large training corpora: cleaning, matching, scoring and packing of documents."""
