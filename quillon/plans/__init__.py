"""Queries over the driver's tables with their SQL."""

from . import decisions, relational, retrieval, validation

_REGISTRIES = (relational.query, retrieval.query, validation.query, decisions.query)
QUERIES = {name: query for r in _REGISTRIES for name, query in r.queries.items()}
ORACLE_SQL = {name: sql for r in _REGISTRIES for name, sql in r.sql.items()}
