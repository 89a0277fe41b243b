"""Registry of this subpackage, and what several operators need from Spark."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import pathloom.llm
from pathloom.session import materialise

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The kernels travel with the tasks, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(pathloom.llm)

CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    old = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, old)


def step(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.  The
    shuffle files of the job go as soon as the table stands."""
    with setting(df.sparkSession, CLEAN, "true"):
        return materialise(df, name)


def with_row_key(docs: DataFrame, key: str, doc_id: str = "doc_id") -> DataFrame:
    """The rows with a number of their own in ``key``, in the order of ``doc_id`` (nulls
    first).  Written, so that all that reads it sees the same numbers."""
    order = [F.col(doc_id).cast("bigint"), F.xxhash64(*docs.columns)]
    rows = docs.repartitionByRange(*order).sortWithinPartitions(*order)
    return step(rows.withColumn(key, F.monotonically_increasing_id()), "row_keys")
