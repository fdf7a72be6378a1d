"""All queries of the core with their SQL twins."""

from __future__ import annotations

from assayweave.plans import queries_measure, queries_search

QUERIES: dict = {**queries_search.QUERIES, **queries_measure.QUERIES}
SQL: dict[str, str] = {**queries_search.SQL, **queries_measure.SQL}
