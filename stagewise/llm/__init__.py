"""Operators of a large-scale training-data pipeline over ``documents``.

Each module holds one operator; ``queries.py`` registers the ``opN_`` queries.
Nothing outside this package imports it.
"""
