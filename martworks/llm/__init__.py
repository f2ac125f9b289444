"""Operators for preparing language-model training data.

One module per operator; ``queries.py`` holds the registered queries, ``corpus_pipeline.py``
at the repository top chains five of them. Nothing else in the library imports this
subpackage.
"""
