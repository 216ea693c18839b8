"""All registered queries of the library and their SQL."""

from __future__ import annotations

from loamstack.plans import generation_queries, join_queries, pixel_queries, pool_queries, quality_queries, sampling_queries, scalar_queries, stats_queries

_MODULES = (scalar_queries, join_queries, sampling_queries, stats_queries, quality_queries, pool_queries, pixel_queries, generation_queries)
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLE_SQL = {k: v for m in _MODULES for k, v in m.ORACLE_SQL.items()}
