"""All registered queries (imports every catalog module)."""

from __future__ import annotations

from .catalog import REGISTRY, QueryFn  # noqa: F401
from .catalog import cleaning, questions, reports, search, stores  # noqa: F401


def queries() -> dict[str, QueryFn]:
    return {k: fn for k, (fn, _) in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: sql for k, (_, sql) in REGISTRY.items() if sql is not None}
