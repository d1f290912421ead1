"""Operators for building training data from large text collections.

Each module holds one operator with its own interface; ``queries`` applies them
to the given tables. Nothing else in the library imports this package.
"""
