"""Operators that prepare training data for language models.

Each module holds one operator; ``queries`` registers them.  Nothing else in
the package imports this subpackage.
"""
