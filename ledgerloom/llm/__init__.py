"""Operators for preparing text corpora and embeddings; nothing outside this package imports it."""
