"""Named queries: each module of this package registers its own in ``catalog``."""

from __future__ import annotations

import importlib

MODULES: tuple[str, ...] = ("scalars", "analytics", "relations", "grids", "standard", "reports", "pages")


def load() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        importlib.import_module(f"corvina.plans.{name}")
