"""Registered queries: each runs an operator over the given tables, with SQL to check it."""

from __future__ import annotations

from skygauge.contract.registry import CHECK_SQL, QUERIES, Query


def _load() -> None:
    from skygauge.contract import checks, dashboards, increments, late, layers, restated, streams  # noqa: F401 - they register queries


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_check_sql() -> dict[str, str]:
    _load()
    return dict(CHECK_SQL)
