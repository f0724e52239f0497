"""The queries of the package over the given tables."""

from __future__ import annotations

import importlib

from . import base

MODULES = ["rows", "texts", "joins", "states", "reports", "landed", "search", "streams"]


def _load() -> None:
    for name in MODULES:
        importlib.import_module(f"{__name__}.{name}")


def queries() -> dict[str, base.Query]:
    _load()
    return dict(base.QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(base.ORACLES)
