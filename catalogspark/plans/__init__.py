"""Registered queries. Each module pairs a Spark query with the SQL that must give the same rows."""

from __future__ import annotations

import importlib

from catalogspark.plans.registry import ORACLES, QUERIES

MODULES: list[str] = [
    "reconcile", "texts", "rulebook", "assembly", "pricing", "catalog", "audits", "files", "streams", "flows", "compare",
]


def load() -> tuple[dict, dict]:
    """All registered queries and their SQL twins."""
    for name in MODULES:
        importlib.import_module(f"catalogspark.plans.{name}")
    return QUERIES, ORACLES
