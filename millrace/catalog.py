"""All queries of the core, and the SQL that gives the same rows."""

from __future__ import annotations

from millrace import problems, queries

QUERIES = {**queries.QUERIES, **problems.QUERIES}
ORACLES: dict[str, str] = {**queries.ORACLES, **problems.ORACLES}
