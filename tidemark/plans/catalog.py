"""All queries of the engine by name, and their SQL."""

from __future__ import annotations

from tidemark.plans import feed_queries, oracle, queries, stream_queries, whole_queries

_PARTS = (whole_queries, stream_queries, feed_queries)

QUERIES = dict(queries.QUERIES)
ORACLE = dict(oracle.ORACLE)
for _part in _PARTS:
    QUERIES |= _part.QUERIES
    ORACLE |= _part.ORACLE
