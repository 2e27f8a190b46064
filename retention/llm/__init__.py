"""Operators of a training-data pipeline over the tables ``documents``,
``benchmark``, ``labels`` and ``conversations``.

One module per operator, with its DuckDB text where SQL can express it; ``queries``
registers them. Nothing else in the library imports this subpackage.
"""
