"""Registered queries over the driver tables, each beside its SQL twin."""

from __future__ import annotations

import importlib
from types import ModuleType

MODULES = ("ingest", "claims", "mixed", "graph", "joins", "aggregates", "writes", "constraints", "media", "awards", "reports", "snapshots", "settled", "feeds", "parts")


def load() -> ModuleType:
    """Import every catalog module and return the filled registry."""
    for name in MODULES:
        importlib.import_module(f"kgspark.catalog.{name}")
    return importlib.import_module("kgspark.catalog.registry")
