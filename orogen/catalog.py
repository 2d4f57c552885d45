"""All registered queries of the library with their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

from .plans import MODULES


def queries() -> dict[str, Callable]:
    return {name: q for module in MODULES for name, q in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
