"""Registry of named queries: a Spark builder and, where SQL can say it, a DuckDB twin."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable  # (spark, sf_dir) -> DataFrame
    oracle: str | None
    operators: str  # SURVEY ids covered


_REGISTRY: dict[str, Query] = {}


def register(name: str, operators: str, oracle: str | None = None):
    def deco(fn):
        if name in _REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        _REGISTRY[name] = Query(name, fn, oracle.strip() if oracle else None, operators)
        return fn

    return deco


def all_queries() -> dict[str, Query]:
    # Importing the modules fills the registry.
    from riskflow.plans import io_queries, queries  # noqa: F401

    return dict(_REGISTRY)
