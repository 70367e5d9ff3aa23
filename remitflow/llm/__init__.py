"""Operators over text corpora and embeddings (training-data preparation)."""
