"""Operators for preparing language-model training data.

Each module holds one operator with its own interface; ``queries`` registers the
queries over the shared test tables. Nothing outside this folder imports it.
"""
