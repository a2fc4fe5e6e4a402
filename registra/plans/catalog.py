"""All registered queries of the engine."""

from __future__ import annotations

from registra.plans import convert, files, joins, listings, search, sources, streams, texts
from registra.plans.common import Query

_PARTS = (listings.CATALOG, texts.CATALOG, joins.CATALOG, search.CATALOG, streams.CATALOG, convert.CATALOG, sources.CATALOG, files.CATALOG)
QUERIES: dict[str, Query] = {name: q for part in _PARTS for name, q in part.queries.items()}
ORACLE_SQL: dict[str, str] = {name: s for part in _PARTS for name, s in part.sql.items()}
