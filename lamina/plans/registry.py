"""All queries of the core, by name."""

from __future__ import annotations

from lamina.plans import general, geometry, sources, tabular

MODULES = [general, tabular, geometry, sources]


def queries() -> dict:
    return {k: v for m in MODULES for k, v in m.QUERIES.items()}


def sql() -> dict:
    return {k: v for m in MODULES for k, v in m.SQL.items()}
