"""Operators for building training data: dedup, filters, mixing, sharding, tokens, search.

Nothing else in the library imports this subpackage. Queries are in ``queries``,
their DuckDB SQL in ``sql``.
"""
