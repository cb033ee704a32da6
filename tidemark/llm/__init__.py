"""Operators of a training-data pipeline over text, vectors and web pages.

Each module holds one operator with a general interface; ``queries`` applies
each to its whole table. Nothing else in the library imports this package.
"""
