"""Registered queries with their SQL counterparts."""

from tripstrata.catalog import increments, oracle, queries

QUERIES = {**queries.QUERIES, **increments.QUERIES}
ORACLE = {**oracle.ORACLE, **increments.ORACLE}
