"""Operators for preparing large text corpora.

Nothing else in the package imports this folder; it may be removed whole.
"""
