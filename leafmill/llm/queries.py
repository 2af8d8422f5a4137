"""The registered queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

import importlib
import pkgutil

import leafmill.llm as package

QUERIES: dict = {}
SQL: dict = {}
for _found in sorted(pkgutil.iter_modules(package.__path__), key=lambda m: m.name):
    if _found.name != "queries":
        _module = importlib.import_module(f"{package.__name__}.{_found.name}")
        QUERIES |= getattr(_module, "QUERIES", {})
        SQL |= getattr(_module, "SQL", {})
