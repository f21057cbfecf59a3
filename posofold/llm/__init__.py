"""Operators for large text corpora; see the docstring of each module."""
