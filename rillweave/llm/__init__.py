"""Operators for large text corpora that are prepared for language-model training.

Nothing outside this package imports it.
"""
