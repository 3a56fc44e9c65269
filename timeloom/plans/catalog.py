"""The registered queries over the driver's tables and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from . import alignment, edits, locations, matches, refinement, registry, rows, texts, timeline, values  # noqa: F401  the modules register their queries


def queries() -> dict[str, Callable]:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.SQL)
