"""Every query of the library by name, and the SQL that gives the same rows."""

from __future__ import annotations

from pagemill.plans import document_queries, table_queries, text_queries

QUERIES: dict = text_queries.QUERIES | table_queries.QUERIES | document_queries.QUERIES
ORACLE_SQL: dict[str, str] = text_queries.SQL | table_queries.SQL | document_queries.SQL
