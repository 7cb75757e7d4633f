"""Operators for building training data out of a corpus of documents."""
