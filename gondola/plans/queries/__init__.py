"""Registered queries, each next to its SQL twin.

Every module holds ``QUERIES`` (name -> callable of a session and a table
folder) and ``ORACLES`` (name -> SQL over the same tables). Names start with the
inventory id of the operator.
"""

from __future__ import annotations

import importlib

_MODULES = ("physics", "layouts", "guided", "enrichment", "knowledge", "sales", "reports",
            "models")


def _merged(attribute: str) -> dict:
    merged: dict = {}
    for name in _MODULES:
        entries = getattr(importlib.import_module(f"{__name__}.{name}"), attribute)
        clash = merged.keys() & entries.keys()
        if clash:
            raise ValueError(f"{attribute} registered twice: {sorted(clash)}")
        merged.update(entries)
    return merged


def all_queries() -> dict:
    return _merged("QUERIES")


def all_oracles() -> dict:
    return _merged("ORACLES")
