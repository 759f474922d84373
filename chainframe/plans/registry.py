"""Registry of queries: name -> (function of Fixtures, oracle SQL over the fixture views or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chainframe.fixtures import Fixtures, with_views

_QUERIES: dict[str, Callable[[Fixtures], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


def register(name: str, run: Callable[[Fixtures], DataFrame], oracle: str | None = None) -> None:
    if name in _QUERIES:
        raise ValueError(f"{name} is registered twice")
    _QUERIES[name] = run
    if oracle is not None:
        _ORACLES[name] = oracle


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {n: (lambda spark, sf_dir, f=f: f(Fixtures(spark, sf_dir))) for n, f in _QUERIES.items()}


def run(name: str, fixtures: Fixtures) -> DataFrame:
    """A query over views that are there already."""
    return _QUERIES[name](fixtures)


def oracle_sql() -> dict[str, str]:
    return {n: with_views(q) for n, q in _ORACLES.items()}
