"""All registered plans and oracle SQL, merged from the plan modules."""

from __future__ import annotations

from logroll.plans import ingest, lifecycle, reports, telemetry

QUERIES = {}
SQL = {}
for _mod in (reports, ingest, lifecycle, telemetry):
    QUERIES.update(_mod.QUERIES)
    SQL.update(_mod.SQL)
