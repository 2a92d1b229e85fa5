"""Operators for preparing training corpora.

Nothing else in the library imports this subpackage. Each module has one operator; the
registered queries are in ``queries``.
"""
