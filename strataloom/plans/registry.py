"""Query registry of the harmonization engine."""

from strataloom.plans import audit_queries, file_queries, job_queries, matrix_queries, sample_queries

QUERIES: dict = matrix_queries.QUERIES | sample_queries.QUERIES | file_queries.QUERIES | job_queries.QUERIES | audit_queries.QUERIES
ORACLE_SQL: dict = matrix_queries.ORACLE_SQL | sample_queries.ORACLE_SQL | file_queries.ORACLE_SQL | job_queries.ORACLE_SQL | audit_queries.ORACLE_SQL
