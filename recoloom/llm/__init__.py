"""Operators of a training-data pipeline over text corpora.

Self-contained: nothing else in the package imports this folder.
"""
