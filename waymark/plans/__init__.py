"""Jobs and registered queries."""

from __future__ import annotations

import importlib

_MODULES = ("messages", "timeline", "cloud", "colour", "grids", "surfaces", "texture", "jobs", "streams")


def catalog():
    for name in _MODULES:
        importlib.import_module(f"waymark.plans.{name}_queries")
    from waymark.plans.registry import REGISTRY

    return dict(REGISTRY)
