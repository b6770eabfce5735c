"""Operators of a training-data pipeline over documents, pages and conversations.

Nothing else in the library imports this subpackage.  The queries and their SQL
are in ``queries``; ``corpus_pipeline.py`` at the repository top chains five of
the operators.
"""
