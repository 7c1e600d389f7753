"""Corpus-preparation operators for training data at scale."""
