"""Operators of a training-data pipeline: tokens, near-duplicates, quality, packing, chat.

Nothing else in the library imports this subpackage; it imports general helpers only.
Queries and their DuckDB SQL are in ``queries.py``.
"""
