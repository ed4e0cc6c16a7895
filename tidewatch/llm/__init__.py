"""Operators of a training-data pipeline over ``documents``.

Nothing outside this subpackage imports it. ``queries.py`` holds the thin
registered queries, ``corpus_pipeline.py`` at the repository top chains five
of the operators.
"""
