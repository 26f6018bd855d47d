"""Import every catalogue module, then expose the filled registry."""

from importlib import import_module
from pkgutil import iter_modules

import brambling.catalog as _here
from brambling.catalog.registry import ORACLES, QUERIES

for _module in sorted(m.name for m in iter_modules(_here.__path__) if m.name.endswith("_queries")):
    import_module(f"brambling.catalog.{_module}")

__all__ = ["ORACLES", "QUERIES"]
