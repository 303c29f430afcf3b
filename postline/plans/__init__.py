"""Registered queries."""

from __future__ import annotations

import importlib
from importlib.util import find_spec

from postline.plans.registry import QUERIES, Query

MODULES = (
    "records",
    "scalars",
    "filters",
    "folding",
    "merging",
    "sources",
    "feeds",
    "companies",
    "reports",
    "streams",
)


def load() -> dict[str, Query]:
    for name in MODULES:
        if find_spec(f"postline.plans.{name}"):
            importlib.import_module(f"postline.plans.{name}")
    return QUERIES
