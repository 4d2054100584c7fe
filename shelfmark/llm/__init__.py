"""Operators of a training-data pipeline over documents, pages and embeddings.

Nothing else in the library imports this subpackage. ``queries`` registers one query per operator;
the other modules hold the operators themselves.
"""
