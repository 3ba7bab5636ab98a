"""Operators for building language-model training data from document tables."""
