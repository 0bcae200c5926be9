"""Operators for building training data out of large corpora.

Nothing else of the library imports this package.
"""
