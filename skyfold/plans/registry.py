"""Imports every module that registers driver queries."""

from __future__ import annotations

import importlib

MODULES = (
    "skyfold.plans.star_queries",
    "skyfold.plans.search_queries",
    "skyfold.plans.inventory_queries",
    "skyfold.plans.reservation_queries",
    "skyfold.plans.quality_queries",
    "skyfold.plans.sink_queries",
    "skyfold.plans.stream_queries",
    "skyfold.plans.extension_queries",
)


def load_all() -> None:
    for m in MODULES:
        importlib.import_module(m)
