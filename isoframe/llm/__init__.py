"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it.  ``queries.py`` and ``sql.py``
hold the registered queries and their DuckDB counterparts.
"""
