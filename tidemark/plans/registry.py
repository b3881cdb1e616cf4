"""All registered queries and the SQL that each must equal."""

from tidemark.plans import clusters, desk, ranking, scans, state, texts

QUERIES: dict = {}
SQL: dict = {}
for module in (texts, scans, state, clusters, ranking, desk):
    QUERIES |= module.QUERIES
    SQL |= module.SQL
