"""Operators for building training data from raw text."""
