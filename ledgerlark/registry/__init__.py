"""Named queries over the driver tables, each with the SQL that must agree with it."""

from __future__ import annotations

from importlib import import_module

from ledgerlark.registry.base import ORACLES, QUERIES

for _module in ("staging", "revenue", "marketing", "history", "quality", "reconcile"):
    import_module(f"ledgerlark.registry.{_module}")

__all__ = ["ORACLES", "QUERIES"]
