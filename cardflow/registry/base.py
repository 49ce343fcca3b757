"""Registration of checked queries: a Spark builder and (where SQL can say it) a DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

BUILDERS: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def check(key: str, oracle: str | None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``key`` with its oracle SQL."""

    def deco(fn: Builder) -> Builder:
        # re-registration (a module reloaded by a harness) replaces the earlier entry
        BUILDERS[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle.strip()
        return fn

    return deco
