"""Registry of named queries: a Spark callable and, where SQL can express it,
the DuckDB oracle text over the same base tables.

Every callable takes ``(spark, sf_dir)``, reads the tables of ``sf_dir``
(positions come from ``events``) and returns a DataFrame in the uniform
output form of :func:`flotilla.plans.present.present`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flotilla.plans.present import present

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    """Decorator: register ``fn`` under ``name`` with an optional oracle text."""
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return present(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from flotilla.plans import (  # noqa: F401
        q_demand, q_io, q_models, q_snapshots, q_state, q_trips,
    )
