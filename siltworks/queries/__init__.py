"""Every registered query with the SQL that must give the same rows."""

from __future__ import annotations

from . import changes, checks, landing, readings, tables, teams, weather
from .base import Query

_MODULES = (readings, weather, teams, changes, landing, tables, checks)


def registry() -> dict[str, Query]:
    found: dict[str, Query] = {}
    for module in _MODULES:
        for name, query in module.QUERIES.items():
            if name in found:
                raise ValueError(f"two queries are named {name}")
            found[name] = query
    return found
