"""Operators for training-data pipelines over text, pages and embeddings.

Nothing else in the library imports this subpackage.
"""
