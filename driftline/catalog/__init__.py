"""All catalogued queries."""

from __future__ import annotations

from importlib import import_module

SECTIONS = ("features", "timejoins", "reports", "profiling", "backtests", "statistics", "scopes", "storage", "models", "live")


def load() -> dict:
    for name in SECTIONS:
        import_module(f"{__name__}.{name}")
    from driftline.catalog.base import CATALOG

    return CATALOG
