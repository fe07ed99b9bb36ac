"""All queries of the core and their SQL."""

from __future__ import annotations

from pegelwerk.queries import events, intervals, labels, levels, misc, p01, p03, p04, p06, recovery, reports, weather

MODULES = (levels, intervals, events, recovery, weather, labels, misc, reports, p01, p03, p04, p06)
FLAGSHIP = "daily_laeq"


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def sql() -> dict[str, str]:
    return {k: q for m in MODULES for k, q in m.SQL.items()}
