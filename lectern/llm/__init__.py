"""Operators for building training data, and the corpus pipeline over them."""
