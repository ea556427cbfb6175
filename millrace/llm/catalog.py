"""All queries of the llm subpackage, and the SQL that gives the same rows."""

from __future__ import annotations

from millrace.llm import problems

QUERIES = {**problems.QUERIES}
ORACLES: dict[str, str] = {}
