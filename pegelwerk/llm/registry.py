"""The queries of the operators tagged llm and their SQL."""

from __future__ import annotations

from pegelwerk.llm import p02, p05, p07, p08, p09

MODULES = (p02, p05, p07, p08, p09)


def queries() -> dict:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def sql() -> dict[str, str]:
    return {k: q for m in MODULES for k, q in m.SQL.items()}
