"""All registered queries and their checking SQL."""

import importlib
import pkgutil

from bidlens.catalog.base import ORACLES, QUERIES

for _module in sorted(m.name for m in pkgutil.iter_modules(__path__)):
    if _module not in ("base", "tables"):
        importlib.import_module(f"{__name__}.{_module}")

__all__ = ["ORACLES", "QUERIES"]
