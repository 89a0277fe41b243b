"""Registry of queries with their SQL counterparts, and shared derived tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pathloom.session import materialise
from pathloom.sources import network as N

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
_TABLES: dict[tuple, DataFrame] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame], written: bool = False) -> DataFrame:
    """A derived table written once per session and read back by later queries,
    as the costs and the working network are in a real run.  ``written``: ``make``
    returns a written table."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _TABLES:
        _TABLES[key] = make() if written else materialise(make(), name)
    return _TABLES[key]


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "links", lambda: N.links(spark, sf_dir))


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return N.nodes(spark, sf_dir).select("nodeid", "x", "y")


def r6(c: Column | str, places: int = 6) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, places)


def forget() -> None:
    """Make later queries build their derived tables anew (used for timing)."""
    _TABLES.clear()
