"""Operators for training-data pipelines over text corpora. Nothing outside this package imports it."""
