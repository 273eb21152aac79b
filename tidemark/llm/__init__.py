"""Operators for preparing text, vectors and media as training data.

Nothing outside this package imports it; deleting the folder leaves the rest
of the library working.
"""
