"""Collects the checks: name, Spark query, and SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks.views import Tables, with_views
from crmweave.operators.lookup import large_lookups

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None, large: bool = False):
    """Register ``fn(tables) -> DataFrame`` under ``name``.

    ``large`` registers a twin, ``name_large``, with the same SQL, whose lookups are all taken
    as too large to broadcast or inline.
    """

    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"check {name!r} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_views(sql)
        if large:
            QUERIES[f"{name}_large"] = lambda spark, sf_dir: _large(fn, spark, sf_dir)
            if sql is not None:
                ORACLES[f"{name}_large"] = ORACLES[name]
        return fn

    return register


def _large(fn: Callable[[Tables], DataFrame], spark: SparkSession, sf_dir: str) -> DataFrame:
    with large_lookups():
        return fn(Tables(spark, sf_dir))
