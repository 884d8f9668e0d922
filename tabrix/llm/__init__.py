"""Operators for preparing language-model training data.

One module per operator; ``queries`` registers the query of each. Nothing
outside this package and ``corpus_pipeline.py`` imports it.
"""
