"""Registered queries over the given tables, each with its SQL check."""

from __future__ import annotations

import importlib

MODULES = ["documents", "metrics", "joins", "expressions", "files"]


def load():
    """(queries, checks) of all catalog modules."""
    from .registry import CHECKS, QUERIES

    for name in MODULES:
        importlib.import_module(f"catalog.{name}")
    return QUERIES, CHECKS
