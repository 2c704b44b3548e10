"""Operators of a training-data pipeline over the ``documents`` and ``embeddings`` tables.

Nothing else in the library imports this subpackage; ``queries`` registers its
queries and SQL. README.md of this folder describes each operator.
"""
