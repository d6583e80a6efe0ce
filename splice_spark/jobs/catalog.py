"""Registered queries over the driver's tables and their SQL."""

from __future__ import annotations

from splice_spark.jobs import analysis_queries, read_queries, score_queries

QUERIES = {**read_queries.QUERIES, **score_queries.QUERIES, **analysis_queries.QUERIES}
ORACLE_SQL = {**read_queries.ORACLE_SQL, **score_queries.ORACLE_SQL, **analysis_queries.ORACLE_SQL}
