"""Collects the registered queries and assembles their checking SQL."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from tallybook.catalog.dialect import DUCK
from tallybook.catalog.views import VIEWS, Source

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}
_MODULES = (
    "match",
    "clean",
    "filters",
    "joins",
    "extracts",
    "ledgers",
    "audit",
    "services",
    "members",
)


def query(name: str, *views: str, sql: str | None = None):
    """Register ``fn(source)``; ``sql`` runs over the same views in the checking engine."""

    def register(fn: Callable[[Source], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = lambda spark, sf_dir: fn(Source(spark, sf_dir))
        if sql is not None:
            _ORACLES[name] = with_views(views, sql)
        return fn

    return register


def with_views(names: tuple[str, ...], sql: str) -> str:
    """``sql`` with the definitions of the views it names, and of those they build on, in front."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        view = VIEWS.get(name)
        if view is None or name in ordered:
            return
        for parent in view.uses:
            visit(parent)
        ordered.append(name)

    for name in names:
        visit(name)
    parts = [f"{n} AS ({VIEWS[n].sql(DUCK)})" for n in ordered]
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return "WITH " + ",\n".join([*parts, body[5:]])
    return (f"WITH {',\n'.join(parts)}\n" if parts else "") + body


def _load() -> None:
    for module in _MODULES:
        import_module(f"tallybook.catalog.{module}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
