"""Corpus operators for training-data pipelines (see the README)."""
