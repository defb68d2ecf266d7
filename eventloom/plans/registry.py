"""All registered queries of shipping and search."""

from __future__ import annotations

from eventloom.plans import catalog, search_queries, shipping_queries

QUERIES = {**catalog.QUERIES, **shipping_queries.QUERIES, **search_queries.QUERIES}
ORACLES = {**catalog.ORACLES, **shipping_queries.ORACLES, **search_queries.ORACLES}
