"""The registered queries, by phase, each with the SQL that gives the same rows."""

from __future__ import annotations

from . import acquisition, audits, cases, entities, history, identified, identity, linkage, matching, occurrences, pages, phases, records, releases, scalar, semantics, works

_PARTS = (scalar, cases, acquisition, pages, records, occurrences, identity, matching, history, works, linkage, entities, identified, audits, semantics, phases, releases)

QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLE_SQL = {name: sql for part in _PARTS for name, sql in part.ORACLE_SQL.items()}
