"""Operators for large-scale training-data pipelines.

Nothing outside this folder imports it. ``queries.QUERIES`` and
``queries.ORACLE_SQL`` hold the registered queries.
"""
