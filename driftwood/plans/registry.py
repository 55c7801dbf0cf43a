"""Registry of query cases: one Spark plan per inventory key, with its DuckDB oracle.

A case is a function ``(spark, sf_dir) -> DataFrame`` built from the library's
operators, plus (for keys checked by SQL) an ANSI SQL string DuckDB runs on the
same parquet tables. ``check`` is ``"S"`` (SQL oracle) or ``"A"`` (assertion
tests under ``tests/``; the driver records a rows-only check).
"""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from driftwood.session import configure

PLAN_MODULES = (
    "medallion", "relational", "windows", "scalars", "collections", "sources",
    "sinks", "streams", "cdc", "quality", "govern", "udfs", "layout", "monitor",
)


@dataclass(frozen=True)
class Case:
    key: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    check: str


CASES: dict[str, Case] = {}


def case(key: str, sql: str | None = None, check: str = "S"):
    """Register ``fn`` under ``key``; ``sql`` is its DuckDB oracle."""

    def deco(fn):
        if key in CASES:
            raise ValueError(f"duplicate case {key}")
        CASES[key] = Case(key, fn, sql, "S" if sql else check)
        return fn

    return deco


def load_all() -> dict[str, Case]:
    for m in PLAN_MODULES:
        try:
            importlib.import_module(f"driftwood.plans.{m}")
        except ModuleNotFoundError as e:  # module not written yet
            if e.name != f"driftwood.plans.{m}":
                raise
    return CASES


def _bind(c: Case):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return c.fn(spark, sf_dir)

    run.__name__ = f"q_{c.key}"
    run.__doc__ = c.fn.__doc__
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _bind(c) for k, c in load_all().items()}


def oracle_sql() -> dict[str, str]:
    return {k: c.sql for k, c in load_all().items() if c.sql}
