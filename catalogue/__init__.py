"""Queries over the driver's tables, each with SQL that states the expected rows."""

from . import analytics, cleaning, gates, loading, orders, parsing, quality, resolving

QUERIES = {}
ORACLES = {}
for _part in (analytics, orders, cleaning, parsing, loading, resolving, quality, gates):
    QUERIES.update(_part.QUERIES)
    ORACLES.update(_part.ORACLES)
