"""Registered queries and their SQL."""

from __future__ import annotations

from jobstrata.plans import changed, queries

QUERIES = {**queries.QUERIES, "p2_found": changed.p2_found}
SQL = {**queries.SQL, "p2_found": changed.P2_SQL}
