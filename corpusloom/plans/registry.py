"""Named queries of the core library and their SQL equivalents."""

from __future__ import annotations

from corpusloom.plans import corpus, evaluation, legal, records, relational, search, sections

_PARTS = (corpus, relational, search, evaluation, records, legal, sections)
QUERIES = {name: q for part in _PARTS for name, q in part.Q.queries.items()}
ORACLE_SQL = {name: sql for part in _PARTS for name, sql in part.Q.sql.items()}
