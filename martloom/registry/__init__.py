"""Every registered query beside the independent SQL that checks it."""

from __future__ import annotations

from importlib import import_module

from martloom.registry.core import QUERIES, RegisteredQuery

for _module in (
    "ingestion", "conforming", "star", "commercial", "finance", "analytics", "operations", "columns", "stored",
):
    import_module(f"martloom.registry.{_module}")

__all__ = ["QUERIES", "RegisteredQuery"]
