"""Operators of a training-data pipeline over the documents and embeddings tables.

Nothing else in the package imports this subpackage. ``queries.py`` holds the
registered queries, ``corpus_pipeline.py`` at the repository top chains five of
the operators.
"""
