"""Operators for preparing large text corpora.

Nothing outside this subpackage imports it, except the guarded hook in ``__spark_entry__``.
"""
