"""Operators for preparing text corpora: quality, sharding, tokens, near copies, archives.

Nothing else in the library imports this subpackage.
"""
