"""Operators for cleaning and encoding large training corpora.

Nothing else in the library imports this subpackage.
"""
