"""Registered queries with the SQL that checks them."""

from __future__ import annotations

import importlib

from lexmill.catalog.registry import ORACLE, QUERIES

MODULES = (
    "sources", "projections", "cleaning", "profiles", "statistics", "vocabulary",
    "tokens", "examples", "scoring", "streams", "reports",
)

for _module in MODULES:
    importlib.import_module(f"lexmill.catalog.{_module}")

__all__ = ["ORACLE", "QUERIES"]
