"""Registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quakespark import adapter
from quakespark.params import PairParams

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Limits used by the registered queries (FIXTURES.md geometry: separations up to 5 km).
PAIRING = PairParams(max_sep=5.0)


def query(name: str, sql: str | None = None):
    """Register ``fn(t) -> DataFrame``; ``t(view)`` gives an adapter view or a table."""
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


class Tables:
    """The test tables and adapter views of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._frames:
            read = adapter.view if name in adapter.VIEWS else adapter.table
            self._frames[name] = read(self.spark, self.sf_dir, name)
        return self._frames[name]

    def once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """The table that ``make`` gives, made at the first call only."""
        if name not in self._frames:
            self._frames[name] = make()
        return self._frames[name]


def rounded(df: DataFrame, **places: int) -> DataFrame:
    """Round the named double columns; other columns stay."""
    return df.withColumns({c: F.round(c, n) for c, n in places.items()})


def with_views(*wanted: str) -> str:
    return "WITH " + adapter.sql_views(*wanted)
