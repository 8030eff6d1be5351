"""Operators for training-data corpora. Nothing else in recordloom imports this package."""
