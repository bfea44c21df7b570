"""Operators for preparing language-model training data, each with its registered query."""
