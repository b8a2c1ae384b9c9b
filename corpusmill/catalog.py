"""The queries over the driver's tables and their SQL, gathered from ``plans``."""

from corpusmill.plans import rule_queries, table_queries, text_queries

QUERIES = {**text_queries.QUERIES, **table_queries.QUERIES, **rule_queries.QUERIES}
ORACLE_SQL = {**text_queries.ORACLE_SQL, **table_queries.ORACLE_SQL, **rule_queries.ORACLE_SQL}
