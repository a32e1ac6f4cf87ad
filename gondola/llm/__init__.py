"""Operators for building training data; nothing else in the library needs them."""
