"""Registered queries and their SQL."""

from catamill.plans import catalog, catalog_oracles, oracles, queries

QUERIES = queries.QUERIES | catalog.QUERIES
ORACLES = oracles.ORACLES | catalog_oracles.ORACLES
