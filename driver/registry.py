"""All registered queries and oracles."""

from __future__ import annotations

from driver import ingest_queries, match_queries, part_queries

_JOBS = (match_queries, part_queries, ingest_queries)

QUERIES = {name: function for job in _JOBS for name, function in job.QUERIES.items()}
ORACLES = {name: sql for job in _JOBS for name, sql in job.ORACLES.items()}
