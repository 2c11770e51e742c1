"""Operators for preparing training text at scale, and their queries.

Nothing else in the library imports this subpackage.
"""
