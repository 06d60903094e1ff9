"""Operators for preparing large training corpora.

Nothing outside this subpackage imports it; the queries are in ``queries.py``.
"""
