"""Operators for preparing training data: quality, duplicates, leaks, secrets, packing.

Nothing else in the library imports this subpackage.
"""
