"""Named queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.workload.derive import Duck, table, with_clause


class Source:
    """Derived tables of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.folder, name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
# Derivations used by oracle SQL alone: name -> (tables needed, SELECT text).
STEPS: dict[str, tuple[tuple[str, ...], str]] = {}


def step(name: str, needs: tuple[str, ...], text: str) -> None:
    STEPS[name] = (needs, text)


def query(name: str, needs: tuple[str, ...] = (), sql: str | None = None):
    """Register a query; ``sql`` is its oracle over the tables in ``needs``."""

    def wrap(fn: Callable[[Source], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Source(spark, folder))
        if sql is not None:
            ORACLES[name] = f"{with_clause(Duck, list(needs), STEPS)} {sql}"
        return fn

    return wrap
