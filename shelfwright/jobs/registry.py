"""All queries of the library and their SQL."""

from shelfwright.jobs import audit_queries, check_queries, composite_queries, queries, source_queries, stream_queries, text_queries  # noqa: F401

QUERIES = queries.QUERIES | stream_queries.QUERIES
ORACLE_SQL = queries.ORACLE_SQL | stream_queries.ORACLE_SQL
