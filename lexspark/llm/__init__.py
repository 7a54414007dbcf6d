"""Operators for large text corpora: deduplication, filtering, scoring, tokenising.

Nothing outside this subpackage imports it.
"""
